"""Runs (maximal periodic stretches of words) of every text, by longest common
extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q, words q apart
being identical, of at least max(``SHORTEST``, 2 * q) words, that neither
neighbouring word extends with period q. A word is dropped from the collapsed
text if a run contains it after that run's first q words.

1. Words become integers (exact: equal numbers, equal words); several texts lie
   in one array, with a number of its own before, between and after them.
2. Harmonic grid. A run of period q holds two neighbouring multiples of q, so
   for every q all pairs (k * q, (k + 1) * q) of a text are tried: n ln n pairs.
   The words the pair agrees on to the right and to the left, and the q between
   them, are the whole run.
3. Extensions. A few words on, both positions of any pair lie in the difference
   cover; the words up to there are compared one by one, which ends nearly all
   pairs. Only for texts with a pair left, the suffixes at cover positions
   (6 of 31) are sorted, by prefix doubling in steps of COVER words, with the
   common prefixes of neighbours under a sparse table: the rest of an extension
   is one range minimum. Extensions to the left are those of the mirrored array.
4. The same stretch found with several periods keeps the smallest.

Nothing is shuffled. Memory of a task grows with ``tb.CHUNK_BYTES`` of text or
one longer text (about 150 bytes a word where its suffixes have to be sorted)
and a slice of ``PAIRS`` pairs, not with the number of pairs.

Null, empty and wordless texts have no run. Rows are independent, so repeated
rows and ids get equal results and an empty table none. Only doc_id and text
are read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

SHORTEST = 12
# fixed values: every residue modulo COVER is a difference of two members
COVER = 31
MEMBERS = (0, 1, 3, 8, 12, 18)
LEAD = 5  # words compared at least before the cover is asked
PAIRS = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def shifts() -> np.ndarray:
    """[a, b]: words to go on (LEAD at least) until residues a, b are members."""
    member = np.zeros(COVER, bool)
    member[list(MEMBERS)] = True
    out = np.full((COVER, COVER), -1, np.int64)
    r = np.arange(COVER)
    for d in range(LEAD + COVER - 1, LEAD - 1, -1):
        at = member[(r + d) % COVER]
        out[at[:, None] & at[None, :]] = d
    return out


SHIFT = shifts()


def common(x: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words x[a:] and x[b:] have in common, at most ``most``, word by word."""
    out = np.zeros(len(a), np.int64)
    act, t = np.flatnonzero(most > 0), 0
    while len(act):
        act = act[x[a[act] + t] == x[b[act] + t]]
        t += 1
        out[act] = t
        act = act[most[act] > t]
    return out


def ranked(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


class Extensions:
    """Longest common extensions to the right of two positions of ``x``, an
    array of texts (numbers >= 0) between negative numbers that occur once."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        pos = np.concatenate([np.arange(m, n, COVER) for m in MEMBERS])
        word = np.concatenate((x - x.min() + 1, np.zeros(COVER, np.int64)))
        radix = int(word.max()) + 1
        rank = np.zeros(len(pos), np.int64)
        for t in range(COVER):
            rank = ranked(rank * radix + word[pos + t])
            if rank.max() + 1 == len(pos):
                break
        place = np.zeros(n + 1, np.int64)
        place[pos] = np.arange(len(pos))
        levels, step = [rank], COVER
        while rank.max() + 1 < len(pos):
            ahead = np.minimum(pos + step, n)  # a cover position or the end
            nxt = np.where(ahead < n, rank[place[ahead]] + 1, 0)
            rank = ranked(rank * (len(pos) + 1) + nxt)
            levels.append(rank)
            step *= 2
        order = np.argsort(rank)
        a, b = pos[order[:-1]].copy(), pos[order[1:]].copy()
        lcp = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            # equal ranks are equal words, so neither runs past the array
            step = COVER << level
            same = levels[level][place[a]] == levels[level][place[b]]
            for v in (a, b, lcp):
                v[same] += step
        lcp += common(x, a, b, np.full(len(a), COVER))
        self.rank = np.zeros(n, np.int32)
        self.rank[pos] = rank
        self.least = [lcp.astype(np.int32)]  # sparse table of range minima
        w = 1
        while 2 * w <= len(lcp):
            last = self.least[-1]
            self.least.append(np.minimum(last[:len(last) - w], last[w:]))
            w *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in common from a on and from b on (a != b)."""
        need = SHIFT[a % COVER, b % COVER]
        out = common(self.x, a, b, need)
        far = np.flatnonzero(out == need)
        i, j = self.rank[a[far] + need[far]], self.rank[b[far] + need[far]]
        lo, hi = np.minimum(i, j), np.maximum(i, j)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            s = level == k
            row = self.least[k]
            out[far[s]] += np.minimum(row[lo[s]], row[hi[s] - (1 << int(k))])
        return out


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(array, place of each text's first word, sizes)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - size
    x = np.full(int(size.sum()) + len(texts) + 1, -1, np.int64)
    if len(texts):
        x[begin[0] - 1], x[begin + size] = -1, -2 - np.arange(len(texts))
        inside = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        x[inside] = np.concatenate(texts)
    return x, begin, size


def grid(size: np.ndarray):
    """All pairs of neighbouring multiples of q, for q up to half a text, in
    slices of about PAIRS: (text, q, the lower multiple)."""
    half = size // 2
    text = np.repeat(np.arange(len(size)), half)
    q = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    count = (size[text] - 1) // q
    ends, lo = np.cumsum(count), 0
    while lo < len(q):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - count[lo] + PAIRS, "right")))
        c = count[lo:hi]
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        p = np.repeat(q[lo:hi], c)
        yield np.repeat(text[lo:hi], c), p, k * p
        lo = hi


def _stretches(x, begin, size, right, left, shortest):
    """Grid pairs -> (text, start, length, period) of long enough stretches, and
    texts that have a pair whose extension reached the cover."""
    out, far = [], np.zeros(len(size), bool)
    for text, q, i in grid(size):
        a = begin[text] + i
        b = a + q
        hold = (x[a] == x[b]) | (x[a - 1] == x[b - 1])
        text, q, a, b = text[hold], q[hold], a[hold], b[hold]
        f, more = right(a, b)
        g, also = left(a, b)
        far[text[more | also]] = True
        keep = f + g + q >= np.maximum(shortest, 2 * q)
        found = np.stack((text, a - g - begin[text], f + g + q, q), 1)[keep]
        out.append(np.unique(found, axis=0) if len(found) else found)
    return (np.concatenate(out) if out else np.zeros((0, 4), np.int64)), far


def runs(texts: list[np.ndarray], shortest: int = SHORTEST) -> np.ndarray:
    """Rows (text, start, length, period), by text, start, period."""
    x, begin, size = joined(texts)
    n = len(x)
    y = x[::-1].copy()

    def few(z, flip):
        def run(a, b):
            if flip:
                a, b = n - a, n - b
            need = SHIFT[a % COVER, b % COVER]
            got = common(z, a, b, need)
            return got, got == need
        return run

    found, far = _stretches(x, begin, size, few(x, False), few(y, True), shortest)
    if far.any():
        which = np.flatnonzero(far)
        found = found[~far[found[:, 0]]]
        x2, begin2, size2 = joined([texts[i] for i in which])
        fwd, bwd, n2 = Extensions(x2), Extensions(x2[::-1].copy()), len(x2)
        whole, _ = _stretches(x2, begin2, size2, lambda a, b: (fwd.right(a, b), a < 0),
                              lambda a, b: (bwd.right(n2 - a, n2 - b), a < 0), shortest)
        whole[:, 0] = which[whole[:, 0]]
        found = np.concatenate((found, whole))
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :3] != found[:-1, :3]).any(1)  # one stretch, its smallest period
    found = found[first]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _find(shortest: int):
    def run(batches):
        for pdf in batches:
            raw = tb.encode(pdf["text"])
            for lo, hi in tb.chunks([len(r) for r in raw]):
                words = [r.split() for r in raw[lo:hi]]  # bytes split at space and \t..\r
                size = np.fromiter(map(len, words), np.int64, len(words))
                flat = np.empty(int(size.sum()), object)
                flat[:] = [w for ws in words for w in ws]
                ids = pd.factorize(flat)[0].astype(np.int64)
                cut = np.concatenate(([0], np.cumsum(size)))
                found = runs([ids[cut[i]:cut[i + 1]] for i in range(hi - lo)], shortest)
                at = np.searchsorted(found[:, 0], np.arange(hi - lo + 1))
                edge = np.zeros(len(flat) + 1, np.int64)
                s = cut[found[:, 0]] + found[:, 1]
                np.add.at(edge, s + found[:, 3], 1)
                np.add.at(edge, s + found[:, 2], -1)
                kept = np.cumsum(edge[:-1]) == 0
                mine = [found[at[i]:at[i + 1]] for i in range(hi - lo)]
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[lo:hi].to_numpy(), "n_words": size,
                    "start": [m[:, 1] for m in mine], "length": [m[:, 2] for m in mine], "period": [m[:, 3] for m in mine],
                    "collapsed": [b" ".join(flat[cut[i]:cut[i + 1]][kept[cut[i]:cut[i + 1]]]).decode("utf-8", "surrogatepass")
                                  for i in range(hi - lo)]})
    return run


def periodic(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (array of start, length,
    period, by start and period) and collapsed (kept words, one space apart)."""
    id_type = docs.schema["doc_id"].dataType
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = src.mapInPandas(_find(shortest), "doc_id string, n_words long, start array<long>, length array<long>, "
                        "period array<long>, collapsed string")
    return d.select(F.col("doc_id").cast(id_type).alias("doc_id"), "n_words",
                    F.arrays_zip("start", "length", "period").alias("runs"), "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; texts of one id in ten (crc32 of the decimal doc_id)
    repeat a stretch of their words, from a word on, to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    d = docs.select("doc_id", "text", ((h - h % 10) / 10).cast("long").alias("g"),
                    F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("w"))
    d = d.select("*", F.size("w").cast("long").alias("n"))
    d = d.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    d = d.select("*", (F.expr("(n - a) div (3 + g % 8)") + 1).cast("int").alias("p"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a").cast("int") + 1, F.col("p")),
                                     F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")),
                                 F.slice(again, F.lit(1), (F.col("n") - F.col("a")).cast("int"))), " ")
    return d.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run (start, length, period, exponent_milli;
    ties: smallest start, then period) and digests of all runs and of the
    collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"),
                                                              (-r["period"]).alias("p"))))
    d = found.select("*", best.alias("best"))
    return d.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
                    F.col("best.l").alias("length"), (-F.col("best.p")).alias("period"),
                    F.floor(F.col("best.l") * 1000 / -F.col("best.p")).alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256"))
