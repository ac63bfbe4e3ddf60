import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import periodic as P


def naive_runs(w, shortest=12):
    """Every period by its stretches of equal words q apart."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(shortest, 2 * q):
                out.setdefault((s, i + q - s), q)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def words_of(rnd, kind, n):
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == "thue":
        return [bin(i).count("1") % 2 for i in range(n)]
    if kind == "blocks":
        out = []
        while len(out) < n:
            unit = [rnd.randrange(50) for _ in range(rnd.randint(1, 45))]
            out += unit * rnd.randint(1, 6)
        return out[:n]
    return [rnd.randrange(kind) for _ in range(n)]


def test_cover_and_shifts():
    assert {(a - b) % P.COVER for a in P.MEMBERS for b in P.MEMBERS} == set(range(P.COVER))
    for a in range(P.COVER):
        for b in range(P.COVER):
            d = P.SHIFT[a, b]
            assert (a + d) % P.COVER in P.MEMBERS and (b + d) % P.COVER in P.MEMBERS and d >= P.LEAD


@pytest.mark.parametrize("seed", [1, 2])
def test_extensions_match_word_by_word(seed):
    rnd = random.Random(seed)
    texts = [np.array(words_of(rnd, k, rnd.randint(2, 400)), np.int64) for k in (1, 2, 50, "blocks", "fibonacci", "blocks")]
    texts += [texts[3], texts[0][:1], texts[4]]
    x, begin, size = P.joined(texts)
    e = P.Extensions(x)
    a = np.array([rnd.randrange(len(x)) for _ in range(3000)])
    b = np.array([rnd.randrange(len(x)) for _ in range(3000)])
    a, b = a[a != b], b[a != b]
    got = e.right(a, b)
    for i, j, k in zip(a.tolist(), b.tolist(), got.tolist()):
        assert (x[i:i + k] == x[j:j + k]).all()
        assert x[i + k] != x[j + k]


@pytest.mark.parametrize("pairs", [P.PAIRS, 50])
def test_runs_match_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(P, "PAIRS", pairs)
    rnd = random.Random(5)
    texts = [words_of(rnd, k, rnd.randint(0, 260)) for k in (1, 2, 2, 3, 40, "blocks", "blocks", "blocks", "fibonacci", "thue") * 3]
    texts += [[], [7], [7] * 11, [7] * 12, list(range(6)) * 2, list(range(6)) + list(range(5)), texts[5], texts[5]]
    got = P.runs([np.array(t, np.int64) for t in texts])
    for i, t in enumerate(texts):
        assert [tuple(r[1:]) for r in got.tolist() if r[0] == i] == naive_runs(t)
    assert len(P.runs([])) == 0


def naive_row(doc_id, text):
    w = (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    w = [x for x in w if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = naive_runs(w)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def got(docs):
    return sorted([tuple(r) for r in P.digests(P.periodic(P.planted(docs))).collect()], key=str)


def test_query_columns_match_brute_force(docs_of):
    rnd = random.Random(8)
    rows = []
    for i in range(150):
        sep = rnd.choice([" ", "  ", "\n", "\t ", "  ", "\r\n"])
        rows.append((i, sep.join(f"w{x}é" for x in words_of(rnd, rnd.choice([1, 2, 300, "blocks"]), rnd.randint(0, 120)))))
    assert got(docs_of(rows).repartition(3)) == sorted([naive_row(*r) for r in rows], key=str)


def test_nulls_repeats_long_text_empty_table_and_extra_columns(docs_of):
    ten = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(None, "a " * 30), (1, None), (2, ""), (2, " \t\n"), (3, "x y " * 20), (3, "x y " * 20), (ten[0], ""), (ten[1], "one"),
            (ten[2], None), (ten[3], "a b c d e f g " * 9)]
    want = sorted([naive_row(*r) for r in rows], key=str)
    assert got(docs_of(rows)) == want
    clash = docs_of(rows).withColumns({"runs": F.lit(1), "w": F.lit(2), "n": F.lit("x"), "start": F.lit(3)}).withColumn("a.b", F.lit(1))
    assert got(clash) == want
    assert got(docs_of([])) == []
    long = " ".join(f"u{i * 7919 % 60000}" for i in range(120_000)) + " z" * 300_000
    r = P.periodic(docs_of([(1, long)])).first()
    assert [tuple(x) for x in r.runs] == [(0, 120_000, 60_000), (120_000, 300_000, 1)]
    assert r.n_words == 420_000 and len(r.collapsed.split()) == 60_001


def test_whole_table_against_brute_force(spark, sf_small):
    from stayline.llm.queries import op11_periodic_runs
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    small = [r for r in rows if len((r[1] or "").split()) < 1500]
    want = sorted([naive_row(*r) for r in small], key=str)
    ids = {r[0] for r in small}
    assert sorted([tuple(r) for r in op11_periodic_runs(spark, sf_small).collect() if r.doc_id in ids], key=str) == want
