import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stayline.llm import mixing as M


def water_fill(sizes, weights, repeats):
    """Targets by repeated resharing of what is above a cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest, ws = total - sum(capped.values()), sum(w[s] for s in names if s not in capped)
        share = {s: rest * w[s] / ws for s in free} if free else {}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: repeats * sizes[s] for s in over})


def corpus(seed):
    rnd = random.Random(seed)
    rows = []
    for s, n, longest in (("a", 300, 30), ("b", 40, 9), (None, 25, 10), ("é", 5, 4), ("zero", 3, 0), ("c", 200, 20)):
        rows += [(len(rows) + i, " ".join("w" for _ in range(rnd.randint(0, longest))), "en", s) for i in range(n)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_shares(docs_of, seed):
    rows = corpus(seed)
    got = M.mix(docs_of(rows).repartition(4), range_rows=37).collect()
    again = M.mix(docs_of(rows).repartition(2), range_rows=500).collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and r.taken % max(r.size, 1) == 0
        assert r.taken <= 3 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert target == pytest.approx(water_fill(sizes, (1, 2, 3), 3))
    assert sum(taken.values()) <= sum(sizes.values())
    for s in target:
        assert abs(taken[s] - target[s]) <= 2 * 30
    assert all(r.source_size == sizes[source[r.doc_id]] for r in got)


def test_mixed_rows_carry_all_columns(docs_of):
    rows = corpus(3)
    docs = docs_of(rows).withColumn("key", F.lit(1)).withColumn("ord", F.lit("x")).withColumn("row", F.lit(2))
    docs = docs.withColumn("copies", F.lit(None).cast("int"))
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    want = {r.doc_id: r.copies for r in M.mix(docs).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def test_nulls_repeated_rows_empty_table(docs_of):
    rows = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (1, "a b", "en", "t"), (None, "x y z", "en", "s"),
            (None, None, None, None), (2, "", "en", "u"), (3, "w " * 50_000, "en", "t")]
    d = docs_of(rows)
    got = M.mix(d).collect()
    assert len(got) == len(rows) and all((r.taken or 0) <= 3 * r.size for r in got)
    assert M.mixed_documents(d).count() == sum(r.copies for r in got)
    assert M.mix(docs_of([])).count() == 0 and M.mixed_documents(docs_of([])).count() == 0
