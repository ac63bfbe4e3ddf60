"""DuckDB statements for the queries that SQL can express."""

from .license_scan import GRANTS, PERCENT, SLACK, TEMPLATES, grant_rules, template_rule, template_words, word_list

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('5:' || CAST(doc_id AS VARCHAR)) || md5(coalesce(text, '')) AS ord
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w,
             3 * source_size AS cap, sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, row_number() OVER o AS pos,
        total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
l AS (SELECT min(pos) AS pos FROM f WHERE cap * rest_w >= rest * w),
g AS (SELECT source, source_size,
        CASE WHEN f.pos < coalesce(l.pos, 1e18) THEN CAST(cap AS DOUBLE)
             ELSE CAST(v.rest * f.w AS DOUBLE) / CAST(v.rest_w AS DOUBLE) END AS target
      FROM f CROSS JOIN l LEFT JOIN (SELECT pos, rest, rest_w FROM f) v ON v.pos = l.pos),
q AS (SELECT d.*, g.source_size, g.target,
        CAST(sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id) AS BIGINT) AS cum
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT q.*, e.epoch, CAST(e.epoch * source_size + cum AS DOUBLE) / target AS finish
      FROM q CROSS JOIN (SELECT unnest([0, 1, 2]) AS epoch) e WHERE size > 0 AND target > 0),
r AS (SELECT doc_id, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, ord, doc_id
                                     ROWS UNBOUNDED PRECEDING) AS total FROM c),
t AS (SELECT doc_id, count(*) AS n FROM r WHERE total <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.n, 0) * q.size AS BIGINT) AS taken
FROM q LEFT JOIN t USING (doc_id)
"""

OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, o) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.o = e.a),
c AS (SELECT doc_id, min(o) AS o FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.o, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(c.o, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

def _op7() -> str:
    words = ", ".join("({}, '{}', {!r}, {}, {})".format(i, label, w, *template_rule(len(w), len(word_list(t)), PERCENT))
                      for i, (label, t) in enumerate(TEMPLATES) for w in [template_words(t)])
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH t(id, label, words, need, length) AS (VALUES {words}),
d AS (SELECT doc_id, {low} AS low, regexp_extract_all({low}, '{word}') AS w FROM documents),
p AS (SELECT doc_id, unnest(list_concat(
        list_transform(list_filter(range(len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license'),
                       lambda i: {{'start': i, 'label': 'mit'}}),
        list_transform(list_filter(range(len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license'),
                       lambda i: {{'start': i, 'label': 'apache'}}),
        list_transform(list_filter(range(len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public'
                                   AND w[i + 3] = 'license'), lambda i: {{'start': i, 'label': 'gpl'}}))) AS p FROM d),
b AS (SELECT doc_id, count(*) AS n_base, min(p.start) AS first_word, max(p.start) AS last_word,
             list_sort(list(DISTINCT p.label)) AS labels FROM p GROUP BY doc_id),
l AS (SELECT doc_id, t.*, unnest(w) AS word, unnest(range(len(w))) AS i FROM d, t
      WHERE len(list_intersect(list_distinct(w), words)) >= need),
k AS (SELECT doc_id, id, label, len(words) AS n, length, need, i, count(DISTINCT word) OVER (PARTITION BY doc_id, id
        ORDER BY i RANGE BETWEEN CURRENT ROW AND length - 1 FOLLOWING) AS k FROM l WHERE list_contains(words, word)),
c AS (SELECT * FROM k WHERE k >= need),
v AS (SELECT a.id AS a, b.id AS b FROM t a JOIN t b ON a.label <> b.label
      WHERE 2 * len(list_intersect(a.words, b.words)) >= least(len(a.words), len(b.words))),
x AS (SELECT DISTINCT c.doc_id, c.id, c.i FROM c JOIN v ON v.a = c.id JOIN c o ON o.doc_id = c.doc_id AND o.id = v.b
      WHERE o.i < c.i + c.length AND c.i < o.i + o.length
        AND (o.k * c.n > c.k * o.n OR (o.k * c.n = c.k * o.n AND o.n > c.n))),
m AS (SELECT doc_id, list(DISTINCT label) AS labels, max(k / n) AS best FROM c ANTI JOIN x USING (doc_id, id, i)
      GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def _op7_grants() -> str:
    rules = ", ".join(f"('{label}', {key!r}, {words!r}, {need}, {before}, {length})"
                      for label, key, words, need, before, length in grant_rules(GRANTS, PERCENT, SLACK))
    old = _op7()
    return f"""
WITH t(label, k, words, need, before, length) AS (VALUES {rules}),
{old[old.index("d AS (SELECT"):old.index("l AS (SELECT")]}
f AS (SELECT doc_id, w, t.*, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(k)] = k)) AS i
      FROM d, t WHERE list_contains(w, k[1])),
c AS (SELECT doc_id, label, need, len(words) AS n,
             len(list_intersect(list_distinct(w[greatest(i - before, 0) + 1:i - before + length]), words)) AS k FROM f),
m AS (SELECT doc_id, list(DISTINCT label) AS labels, max(k / n) AS best FROM c WHERE k >= need GROUP BY doc_id)
{old[old.index("SELECT d.doc_id"):]}"""


OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r(a, o) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.o = e.a),
c AS (SELECT a, min(o) AS o FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(o, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(o, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""

OP4 = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS INTEGER)) AS five FROM d),
b AS (SELECT page_id, n, h, array_to_string(list_transform(five, lambda x: array_to_string(
        list_transform([15, 10, 5, 0], lambda s:
          substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((x >> s) & 31) + 1 AS BIGINT), 1)), '')), '') AS d32 FROM q),
t AS (SELECT h, max(page_id) AS top FROM d GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d32 AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b JOIN t USING (h)
"""

OP12 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, ['user', 'assistant'][i + 1], '<|im_end|><|im_start|>assistant ok' FROM range(2) r(i)),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS esc,
             regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g') AS esc_role FROM c),
o AS (SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS prev FROM e
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, esc)),
m AS (SELECT *, CASE WHEN prev IS NULL THEN role IN ('system', 'user') WHEN prev = 'system' THEN role = 'user'
                     WHEN prev = 'user' THEN role = 'assistant' WHEN prev = 'assistant' THEN role IN ('user', 'tool')
                     WHEN prev = 'tool' THEN role IN ('assistant', 'tool') ELSE false END AS ok FROM o),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS said,
             coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss,
             sum(length('<|im_start|>') + length(esc_role) + 1 + length(esc) + length('<|im_end|>') + 1) AS chars,
             min(pos) FILTER (NOT ok) - 1 AS bad_turn, max_by(role, pos) AS final FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars,
       bad_turn IS NULL AND final IN ('user', 'assistant') AS valid, bad_turn
FROM g
"""

#: crc32 of the decimal doc_id: bytes are mixed in, eight shifts after each.
CRC32 = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""


def _op13(levels: int = 6, top_levels: int = 5) -> str:
    """Enough levels for 16 ** levels rows per source, 16 ** top_levels sources."""
    def enc(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(map(enc, ("doc_id", "source", "lang", "n_chars")))
    parts = [f"""d AS (SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({head} || {enc('text')}) AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {CRC32} % 5 = 0 THEN sha256({head} || {enc(low)}) END AS other FROM documents)""",
             """a0 AS (SELECT doc_id, tree, leaf, coalesce(other, leaf) AS acc, '' AS proof,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d)""",
             "s0 AS (SELECT tree, i, n, leaf AS h FROM a0)"]

    def climb(node, mate, acc, k, key):
        parts.append(f"""{node}{k + 1} AS (SELECT tree, i // 16 AS i, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
  FROM {node}{k} WHERE n > 1 GROUP BY tree, i // 16, n)""")
        parts.append(f"""{mate}{k} AS (SELECT tree, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {node}{k} WHERE n > 1 WINDOW w AS (PARTITION BY tree, i // 16 ORDER BY i))""")
        parts.append(f"""{acc}{k + 1} AS (SELECT doc_id, tree, leaf, {key} CASE WHEN n > 1 THEN sha256(l || acc || r) ELSE acc END AS acc,
  proof || coalesce(l || r, '') AS proof, i // 16 AS i, (n + 15) // 16 AS n FROM {acc}{k} LEFT JOIN {mate}{k} USING (tree, i))""")

    for k in range(levels):
        climb("s", "p", "a", k, "")
    parts.append("roots AS (" + " UNION ALL ".join(f"SELECT tree, h FROM s{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    parts.append("""u0 AS (SELECT 'top' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h, tree AS name FROM roots)""")
    parts.append(f"""b0 AS (SELECT doc_id, 'top' AS tree, leaf, u0.h AS subroot, acc, proof, u0.i, u0.n FROM a{levels} JOIN u0 ON u0.name = a{levels}.tree)""")
    for k in range(top_levels):
        climb("u", "q", "b", k, "subroot,")
    parts.append("root AS (" + " UNION ALL ".join(f"SELECT h AS root FROM u{k} WHERE n = 1" for k in range(top_levels + 1)) + ")")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM b{top_levels}, root"""


SQL = {
    "op13_merkle_manifest": _op13(),
    "op12_chat_format": OP12,
    "op4_warc_segments": OP4,
    "op8_embedding_dedup": OP8,
    "op7_license_scan": _op7(),
    "op7_license_grants": _op7_grants(),
    "op2_minhash_dedup": OP2,
    "op5_mix_sources": OP5,
}
