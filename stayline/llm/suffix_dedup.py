"""Removal of repeated byte strings by a common-prefix-aware merge sort of
suffixes.

A byte goes if it lies in a ``length``-byte string that also starts anywhere
else. Strings are judged on the input; matches never cross documents.

1. Anchors. In every ``length``-byte window the ``GRAM``-byte string with the
   smallest hash (leftmost on ties) is the window's anchor, so equal windows
   have equal anchors at equal offsets. An anchor and the stretch of windows it
   serves form a context of fewer than 2 * ``length`` bytes. Anchors whose gram
   occurs once in the corpus cannot lie in a repeated window and end here.
2. Equal contexts are folded into one class with a count; a class counted
   twice is repeated as a whole.
3. Sort. Where one gram has several contexts, the suffixes that start at the
   anchors are sorted: each task writes sorted, front-coded runs, cut at
   splitters, and each receiving task merges its runs with a loser tree that
   compares stored common prefixes first and bytes only beyond them. The merge
   yields each suffix's common prefix with its predecessor, and so, for every
   offset, which suffixes agree far enough to the right; agreement to the left
   is refined byte by byte. Windows that agree both ways occur more than once.
4. Covered windows go back to their documents and are cut out.

A gram with more than ``hot`` different contexts does not enter one merge
task: its windows are grouped by content over all tasks instead (exact too).

Null text is empty. Rows with equal texts get equal results, whatever their
doc_id; documents shorter than ``length`` bytes lose nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .staging import stage_path, staged, whole_row

GRAM = 32
HOT = 50_000
BLOCK = 2048
TASK_SUFFIXES = 50_000
SAMPLE = 20_000


def anchors(raw: list[bytes], length: int, gram: int):
    """Anchors of texts laid end to end: (text index, anchor position in the
    text, first and last window start it serves, gram hash, context hash)."""
    buf = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    span = length - gram + 1
    empty = np.zeros(0, np.int64)
    if len(buf) < length + 1:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    hashed = tb.SpanHash(buf)
    pos = np.arange(len(buf) - gram + 1)
    g = hashed.spans(pos, pos + gram)
    low = np.uint64(max(24, int(len(buf)).bit_length()))
    key = ((g >> low) << low) | pos.view(np.uint64)
    m, w = key, 1
    while 2 * w <= span:
        m = np.minimum(m[:len(m) - w], m[w:])
        w *= 2
    k = len(key) - span + 1
    m = np.minimum(m[:k], m[span - w:span - w + k])
    at = (m & ((np.uint64(1) << low) - np.uint64(1))).view(np.int64)
    # window starts whose window stays inside one text
    inside = np.zeros(k + 1, np.int8)
    long = np.flatnonzero(size >= length)
    inside[begin[long]] += 1
    inside[begin[long] + size[long] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(inside[:k]))
    if len(start) == 0:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    at = at[start]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    first, last, at = start[new], start[np.concatenate((new[1:], [len(start)])) - 1], at[new]
    text = np.searchsorted(begin, first, "right") - 1
    ctx = hashed.spans(first, last + length) ^ tb.mix64((at - first).astype(np.uint64))
    off = begin[text]
    return text, at - off, first - off, last - off, g[at], ctx


def _grams(length: int, gram: int):
    """Per text: hashes of its anchors' grams with their counts (a line that is
    repeated inside a text is one row), and one gram's bytes as a sample."""
    def run(batches):
        for pdf in batches:
            for lo, hi, raw in tb.pieces(pdf["text"]):
                text, at, _, _, g, _ = anchors(raw, length, gram)
                cut = np.searchsorted(text, np.arange(hi - lo + 1))
                hs, times, sample = [], [], []
                for i in range(hi - lo):
                    h = g[cut[i]:cut[i + 1]]
                    kinds, n = np.unique(h.view(np.int64), return_counts=True)
                    hs.append(kinds)
                    times.append(n.astype(np.int32))
                    p = at[cut[i] + int(np.argmin(tb.mix64(h)))] if len(h) else 0
                    sample.append(raw[i][p:p + gram] if len(h) else None)
                yield pd.DataFrame({"tk": pdf["tk"].iloc[lo:hi].to_numpy(),
                                    "n_bytes": [len(r) for r in raw],
                                    "sha": [hashlib.sha256(r).hexdigest() for r in raw],
                                    "h": hs, "times": times, "sample": sample,
                                    "doc_id": pdf["doc_id"].iloc[lo:hi].to_numpy()})
    return run


def _members(length: int, gram: int):
    """Anchors of a text whose gram is in its list ``hs``."""
    def run(batches):
        for pdf in batches:
            for lo, hi, raw in tb.pieces(pdf["text"]):
                text, at, first, last, g, c = anchors(raw, length, gram)
                cut = np.searchsorted(text, np.arange(hi - lo + 1))
                keep = np.zeros(len(g), bool)
                for i in range(hi - lo):
                    s = slice(cut[i], cut[i + 1])
                    keep[s] = np.isin(g[s].view(np.int64), pdf["hs"].iloc[lo + i])
                k = np.flatnonzero(keep)
                yield pd.DataFrame({"tk": pdf["tk"].iloc[lo:hi].to_numpy()[text[k]],
                                    "mult": pdf["mult"].iloc[lo:hi].to_numpy()[text[k]],
                                    "h": g[k].view(np.int64), "c": c[k].view(np.int64), "at": at[k],
                                    "o1": (at - last)[k], "o2": (at - first)[k]})
    return run


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of a and b, known to be at least ``start``."""
    n = min(len(a), len(b))
    while start < n:
        step = min(n, start + 32)
        if a[start:step] == b[start:step]:
            start = step
            continue
        while a[start] == b[start]:
            start += 1
        return start
    return n


def front_code(sorted_suffixes: list[bytes]):
    """(common prefixes with the predecessor, the remaining bytes)."""
    lcp, tails, last = [], [], b""
    for s in sorted_suffixes:
        k = shared_prefix(last, s)
        lcp.append(k)
        tails.append(s[k:])
        last = s
    return lcp, tails


def _runs(length: int, cuts: list[bytes]):
    """Contexts -> sorted, front-coded blocks, one run per input batch."""
    from bisect import bisect_right

    def run(batches):
        task = TaskContext.get().partitionId()
        for no, pdf in enumerate(batches):
            raw = tb.encode(pdf["text"])
            rows = []
            for r, reps in zip(raw, pdf["reps"]):
                for x in reps:
                    at, o1, o2 = x["at"], x["o1"], x["o2"]
                    rows.append((r[at:at - o1 + length], r[at - o2:at], x["h"], x["c"], o1, o2, x["n"]))
            rows.sort(key=lambda x: x[0])
            part = [bisect_right(cuts, x[0][:GRAM]) for x in rows]
            out, lo = [], 0
            while lo < len(rows):
                hi = min(lo + BLOCK, bisect_right(part, part[lo]))
                block = rows[lo:hi]
                lcp, tails = front_code([x[0] for x in block])
                out.append((part[lo], task * 1_000_000 + no, lo, lcp, tails, [x[1] for x in block],
                            *[[x[i] for x in block] for i in range(2, 7)]))
                lo = hi
            if out:
                yield pd.DataFrame(out, columns=["part", "run", "seq", "lcp", "tail", "left", "h", "c",
                                                 "o1", "o2", "n"])
    return run


RUN_SCHEMA = ("part int, run long, seq int, lcp array<int>, tail array<binary>, left array<binary>, "
              "h array<long>, c array<long>, o1 array<int>, o2 array<int>, n array<long>")


class Run:
    """Cursor over one front-coded run: its blocks in order."""

    def __init__(self, blocks):
        self.blocks, self.b, self.i, self.cur, self.lcp = blocks, 0, -1, b"", 0
        self.done = False
        self.next()

    def next(self):
        """Step on; ``lcp`` becomes the common prefix with the suffix left."""
        self.i += 1
        if self.i == len(self.blocks[self.b]["lcp"]):
            self.b, self.i = self.b + 1, 0
        if self.b == len(self.blocks):
            self.done = True
            return
        block = self.blocks[self.b]
        k = int(block["lcp"][self.i])
        s = (self.cur[:k] if self.i else b"") + block["tail"][self.i]
        if self.i == 0:  # blocks restart their coding
            k = shared_prefix(self.cur, s)
        self.cur, self.lcp = s, k


def merge(runs: list):
    """Loser-tree merge of runs. Yields (run, common prefix with the suffix
    yielded before). Every cursor in the tree carries its common prefix with
    the last winner; of two, the one with the longer prefix is smaller, and
    only on equal prefixes are bytes compared, from that prefix on."""
    k = 1
    while k < len(runs):
        k *= 2
    runs = list(runs) + [None] * (k - len(runs))
    for r in runs:
        if r is not None:
            r.lcp = 0

    def play(a, b):
        """(winner, loser); the loser's prefix is then with the winner."""
        if a is None or a.done:
            return b, a
        if b is None or b.done:
            return a, b
        if a.lcp != b.lcp:
            return (a, b) if a.lcp > b.lcp else (b, a)
        n = shared_prefix(a.cur, b.cur, a.lcp)
        if a.cur[n:n + 1] <= b.cur[n:n + 1]:
            b.lcp = n
            return a, b
        a.lcp = n
        return b, a

    tree = [None] * k

    def build(node):
        if node >= k:
            return runs[node - k]
        win, lose = play(build(2 * node), build(2 * node + 1))
        tree[node] = lose
        return win

    place = {id(r): i for i, r in enumerate(runs) if r is not None}
    top = build(1) if k > 1 else runs[0]
    while top is not None and not top.done:
        yield top, top.lcp
        node = (place[id(top)] + k) // 2
        top.next()
        while node >= 1:
            top, tree[node] = play(top, tree[node])
            node //= 2


def repeated_offsets(lcp, left, o1, o2, n, length):
    """Offsets of repeated windows, from suffixes in sorted order.

    lcp: common prefix of each suffix with its predecessor; left: the bytes
    before each suffix; [o1, o2]: offsets of the windows it serves; n: its
    count. Returns (suffix index, first offset, last offset) of maximal runs."""
    m = len(lcp)
    longest = int(o2.max()) if m else -1
    back = np.zeros((m, longest + 1), np.uint8)
    for i, s in enumerate(left):
        if s:
            back[i, :len(s)] = np.frombuffer(s, np.uint8)[::-1]
    hit = np.zeros((m, longest + 2), bool)
    group = np.cumsum(lcp < GRAM).astype(np.int64)  # one gram
    act = np.arange(m)
    same = group.copy()  # gram and the o bytes to its left
    for o in range(longest + 1):
        # who cannot agree with another any more drops out
        _, inv, cnt = np.unique(same, return_inverse=True, return_counts=True)
        tot = np.bincount(inv, weights=n[act])
        alive = (tot[inv] > 1) & (o2[act] >= o)
        act, same = act[alive], inv[alive].astype(np.int64)
        if len(act) == 0:
            break
        right = np.cumsum(lcp < length - o)
        here = o1[act] <= o
        key = same[here] * (m + 1) + right[act[here]]
        _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
        tot = np.bincount(inv, weights=n[act[here]])
        hit[act[here], o] = tot[inv] > 1
        same = same * 256 + back[act, o]
    edge = np.diff(np.concatenate((np.zeros((m, 1), np.int8), hit.astype(np.int8)), axis=1), axis=1)
    i, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return i, a, b - 1


def _merge_part(length: int, batch: int = 20_000):
    def resolve(rows):
        lcp = np.array([r[0] for r in rows], np.int64)
        arr = [np.array([r[j] for r in rows], np.int64) for j in range(2, 7)]
        i, a, b = repeated_offsets(lcp, [r[1] for r in rows], arr[2], arr[3], arr[4], length)
        return pd.DataFrame({"h": arr[0][i], "c": arr[1][i], "a": a, "b": b})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks: dict = {}
        for r in pdf.sort_values(["run", "seq"]).to_dict("records"):
            blocks.setdefault(r["run"], []).append(r)
        out, rows = [], []
        for top, lcp in merge([Run(b) for b in blocks.values()]):
            if len(rows) >= batch and lcp < GRAM:  # a new gram starts
                out.append(resolve(rows))
                rows = []
            b, i = top.blocks[top.b], top.i
            rows.append((lcp if rows else 0, b["left"][i], b["h"][i], b["c"][i], b["o1"][i], b["o2"][i], b["n"][i]))
        if rows:
            out.append(resolve(rows))
        return pd.concat(out) if out else pd.DataFrame({"h": [], "c": [], "a": [], "b": []}).astype("int64")
    return run


def _window_hashes(length: int):
    """Windows of hot grams by content: (h, c, offset, window hash, count)."""
    def run(batches):
        for pdf in batches:
            for text, reps in zip(tb.encode(pdf["text"]), pdf["reps"]):
                hashed = tb.SpanHash(np.frombuffer(text, np.uint8))
                for x in reps:
                    o = np.arange(x["o1"], x["o2"] + 1)
                    s = x["at"] - o
                    yield pd.DataFrame({"h": x["h"], "c": x["c"], "o": o,
                                        "w": hashed.spans(s, s + length).view(np.int64), "n": x["n"]})
    return run


def _cut(length: int):
    """Texts and covered windows -> sizes, digest and text of what is left."""
    def run(batches):
        for pdf in batches:
            out = []
            for raw, spans in zip(tb.encode(pdf["text"]), pdf["spans"]):
                edge = np.zeros(len(raw) + 1, np.int64)
                s = np.array([(x["s"], x["e"]) for x in spans], np.int64).reshape(-1, 2)
                np.add.at(edge, s[:, 0], 1)
                np.add.at(edge, s[:, 1] + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                runs = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(np.int8)) == 1)
                out.append((int(gone.sum()), len(runs), hashlib.sha256(left).hexdigest(),
                            left.decode("utf-8", "ignore")))
            part = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept"])
            part.insert(0, "tk", pdf["tk"].to_numpy())
            yield part
    return run


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in buckets of ``key``: later joins on it move only the
    other side."""
    spark = df.sparkSession
    path = stage_path(spark, "suffix-texts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry only; the files of an external table stay
    return out


def repeats(docs: DataFrame, length: int = 200, gram: int = GRAM, hot: int = HOT,
            task_suffixes: int = TASK_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, tk, n_bytes, n_removed, n_spans,
    kept_sha256; one row per text that loses bytes: tk and the text left)."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                      F.xxhash64("text").alias("tk0"), F.xxhash64(F.lit(7), "text").alias("tk1"))
    src = src.select("doc_id", "text", F.concat(F.hex("tk0"), F.hex("tk1")).alias("tk"))
    id_type = docs.schema["doc_id"].dataType
    rows = staged(src.mapInPandas(_grams(length, gram), "tk string, n_bytes long, sha string, h array<long>, times array<int>, "
                                  "sample binary, doc_id string")
                  .withColumn("doc_id", F.col("doc_id").cast(id_type)), "suffix-grams")
    each = rows.groupBy("tk").agg(F.count(F.lit(1)).alias("mult"))
    gram_rows = rows.select("tk", F.inline(F.arrays_zip("h", "times")))
    dup = staged(gram_rows.groupBy("h").agg(F.sum("times").alias("n")).where("n > 1").select("h"), "suffix-twice")
    need = staged(gram_rows.select("tk", "h").join(dup, "h", "left_semi").groupBy("tk")
                  .agg(F.collect_set("h").alias("hs"))
                  .join(each, "tk"), "suffix-need")
    texts = _bucketed(src.select("tk", "text").join(need.select("tk"), "tk", "left_semi")
                      .groupBy("tk").agg(F.first("text").alias("text")), "tk")
    members = staged(texts.join(need, "tk").mapInPandas(
        _members(length, gram), "tk string, mult long, h long, c long, at long, o1 int, o2 int"), "suffix-anchors")
    classes = staged(members.groupBy("h", "c").agg(
        F.sum("mult").alias("n"), F.min(F.struct("tk", "at", "o1", "o2")).alias("rep")), "suffix-classes")
    several = classes.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    mixed = staged(classes.join(several, "h").select("h", "c", "n", "m", "rep.*"), "suffix-mixed")

    def contexts(which: DataFrame) -> DataFrame:
        reps = which.groupBy("tk").agg(F.sort_array(F.collect_list(F.struct("at", "o1", "o2", "h", "c", "n"))).alias("reps"))
        return texts.join(reps, "tk")

    parts = max(1, -(-mixed.where(F.col("m") <= hot).count() // task_suffixes))
    total = rows.count()
    some = (rows.where("sample is not null").select("sample")
            .sample(min(1.0, SAMPLE / max(total, 1)), seed=9).limit(2 * SAMPLE).collect())  # bounded
    keys = sorted(bytes(r[0]) for r in some)
    cuts = sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []
    merged = (contexts(mixed.where(F.col("m") <= hot)).mapInPandas(_runs(length, cuts), RUN_SCHEMA)
              .groupBy("part").applyInPandas(_merge_part(length), "h long, c long, a long, b long"))
    big = mixed.where(F.col("m") > hot)
    if big.take(1):
        w = staged(contexts(big).mapInPandas(_window_hashes(length), "h long, c long, o int, w long, n long"), "suffix-hot")
        twice = w.groupBy("h", "o", "w").agg(F.sum("n").alias("k")).where("k > 1")
        merged = merged.unionByName(w.join(twice, ["h", "o", "w"]).select(
            "h", "c", F.col("o").cast("long").alias("a"), F.col("o").cast("long").alias("b")))
    whole = classes.where("n > 1").select("h", "c", F.lit(0).cast("long").alias("a"),
                                          F.lit(length).cast("long").alias("b"))
    ranges = staged(merged.unionByName(whole), "suffix-ranges")
    hit = members.join(ranges, ["h", "c"])
    # offset o at anchor `at` is the window that starts at `at - o`
    spans = hit.select("tk", (F.col("at") - F.least("b", "o2")).alias("s"),
                       (F.col("at") - F.greatest("a", "o1")).alias("e"))
    spans = spans.groupBy("tk").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    done = staged(texts.join(spans, "tk").mapInPandas(
        _cut(length), "tk string, n_removed long, n_spans long, kept_sha256 string, kept string"), "suffix-cut")
    out = rows.select("doc_id", "tk", "n_bytes", "sha").join(done.drop("kept"), "tk", "left")
    zero = F.lit(0).cast("long")
    out = out.select("doc_id", "tk", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                     F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
    return out, done.select("tk", "kept")


def without_repeats(docs: DataFrame, length: int = 200, **kw) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (bytes of a cut
    character that are left over go too); all other columns as they are."""
    _, kept = repeats(docs, length, **kw)
    key = F.concat(F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit(7), "text")))
    d = (docs.select(whole_row(docs).alias("row"), key.alias("key"))
         .join(kept, F.col("key") == F.col("tk"), "left"))
    columns = [F.coalesce("kept", "row.text").alias("text") if c == "text" else F.col("row")[c].alias(c)
               for c in docs.columns]
    return d.select(*columns)
