import random
from collections import defaultdict

import pytest

from stayline.llm import packing as P


def naive(sizes, lengths, open_cost):
    """Best fit by scanning all open bins."""
    bins, place, rest = [], [], sum(sizes)
    for s in sizes:
        rest -= s
        fit = [(n - u, i) for i, (u, n) in enumerate(bins) if n - u >= s]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            n = min((n for n in sorted(lengths) if n >= s),
                    key=lambda n: ((n + open_cost) / min(n, s + rest), -n))
            bins.append([0, n])
        bins[i][0] += s
        place.append(i)
    return place, [min(n for n in lengths if n >= u) for u, _ in bins]


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_scan_of_all_bins(seed):
    rnd = random.Random(seed)
    lengths = rnd.choice([(8, 16, 32), (100,), (10, 64)])
    sizes = sorted((rnd.randint(1, max(lengths)) for _ in range(rnd.randint(0, 120))), reverse=True)
    place, offset, length = P.pack(sizes, lengths, 2)
    assert (place, length) == naive(sizes, lengths, 2)


def check(rows, sizes, lengths):
    by_bin, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        if r.bin is None:
            assert r.size == 0
            by_doc[r.doc_id].append((0, 0))
            continue
        by_bin[r.bin].append((r.bin_offset, r.size, r.bin_length))
        by_doc[r.doc_id].append((r.start, r.size))
    for parts in by_bin.values():
        at = 0
        for off, size, _ in sorted(parts):
            assert off == at
            at += size
        n = parts[0][2]
        assert n == min(x for x in lengths if x >= at) and all(p[2] == n for p in parts)
    for doc, total in sizes.items():
        assert sum(s for _, s in by_doc[doc]) == total


def test_every_word_is_in_one_bin(docs_of):
    rnd = random.Random(3)
    texts = [" ".join("w" for _ in range(rnd.choice([0, 1, 3, 9, 40, 200]))) for _ in range(120)] + [None]
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    rows = P.packed(docs, lengths=(16, 32, 64), shard_rows=50).collect()
    check(rows, {i: len((t or "").split()) for i, t in enumerate(texts)}, (16, 32, 64))


def test_repeated_rows_null_ids_empty_table(docs_of):
    rows = P.packed(docs_of([(1, "a b c"), (1, "a b c"), (1, "x"), (None, "y z"), (None, None)]), lengths=(4, 8)).collect()
    check(rows, {1: 7, None: 2}, (4, 8))
    assert P.packed(docs_of([])).count() == 0
