import random
import re

import numpy as np
import pytest

from stayline.llm import minhash_dedup as M


def shingle_set(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((d, len(sets[i]), c, (d == c) if d is not None else c is None))
    return sorted(out, key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    text = lambda n: [rnd.choice("abcdefgh") + str(rnd.randint(0, 400)) for _ in range(n)]
    rows = []
    for n in (30, 60, 200):
        base = text(n)
        for _ in range(25):  # near copies at many distances
            t = list(base)
            for _ in range(rnd.randint(0, max(1, n // 20))):
                t[rnd.randrange(n)] = "edit" + str(rnd.randint(0, 99))
            rows.append(" ".join(t))
    rows += [" ".join(text(rnd.randint(1, 50))) for _ in range(40)]
    rows += [rows[0], rows[0].upper(), rows[3].replace(" ", "\t\n "), "", " \n", None, "one two", "One  two", "x" * 10]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,percent,tile", [(1, 85, 1024), (2, 85, 4), (3, 80, 3)])
def test_matches_brute_force(docs_of, seed, percent, tile):
    rows = list(enumerate(corpus(seed)))
    got = M.near_duplicates(docs_of(rows), percent=percent, tile=tile)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=repr)
    assert got == brute(rows, percent)


def test_nulls_repeated_ids_empty_table(docs_of):
    rows = [(None, "a b c d e f"), (None, "p q"), (3, "a b c d e f"), (3, "other text here"), (4, None), (4, "p q r s t u v")]
    got = M.near_duplicates(docs_of(rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=repr) == brute(rows, 85)
    assert M.near_duplicates(docs_of([])).count() == 0


def test_one_row_of_each_group_stays(docs_of):
    rows = list(enumerate(corpus(5)))
    kept = M.one_per_group(docs_of(rows), percent=80)
    want = {d for d, n, c, k in brute(rows, 80) if k}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    twice = docs_of([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, ""), (2, "")])
    assert sorted(r.doc_id for r in M.one_per_group(twice).collect()) == [1, 2, 2]


def test_estimate_counts_agreeing_codes(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, M.WORDS64).astype(np.int64)
    b = a.copy()
    b[0] ^= 0xF  # one code differs
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<long>, b array<long>")
    got = df.select(M.estimate("a", "b")).first()[0]
    chance = 2.0 ** -M.BITS
    assert got == pytest.approx((1 - 1 / M.PERMS - chance) / (1 - chance))
    assert M._agree(np.stack([a, b]).view(np.uint64), 0, np.array([1]))[0] == M.PERMS - 1


def test_texts_are_encoded_piece_by_piece():
    """Pieces are bounded, in order and whole, and no text is encoded before its piece is due."""
    from stayline.llm import textbytes as tb

    texts = ["a" * 3, None, "é" * 4, "", "b" * 25, "c"]
    got = list(tb.pieces(texts, 10))
    assert [g[:2] for g in got] == [(0, 2), (2, 4), (4, 5), (5, 6)]
    assert [r for _, _, raw in got for r in raw] == tb.encode(texts)
    seen = []
    first = next(tb.pieces((seen.append(t) or t for t in ["x" * 8] * 1000), 10))
    assert first == (0, 1, [b"x" * 8]) and len(seen) == 2
    assert list(tb.pieces([], 10)) == []
