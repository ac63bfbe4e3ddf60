import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import embedding_dedup as E


def brute(rows, threshold):
    v = {}
    for k, (_, x) in enumerate(rows):
        if x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x):
            v[k] = np.array(x, np.float32).astype(np.float64)
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    n = [0] * len(rows)
    for a in v:
        for b in v:
            if a < b and len(v[a]) == len(v[b]) and v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]) >= threshold:
                n[a] += 1
                n[b] += 1
                up[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((i, n[k], c, (i == c) if i is not None else c is None))
    return sorted(out, key=repr)


def corpus(seed, dim):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, dim)) * np.linspace(2, 0.2, dim)
    rows = [list(map(float, b + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.3, 0.5]))) for b in base for _ in range(4)]
    rows = [(i, r) for i, r in enumerate(rows)]
    rows += [(500 + i, rows[3][1]) for i in range(15)]
    rows += [(600, [2 * x for x in rows[7][1]]), (601, [-x for x in rows[7][1]]), (602, None), (603, []),
             (604, [0.0] * dim), (605, [float("inf")] * dim), (606, [None] * dim), (607, [1.0, 2.0]), (608, [2.0, 4.1]),
             (None, rows[9][1]), (None, [float(k == 0) for k in range(dim)]), (9, rows[20][1])]
    return rows


@pytest.mark.parametrize("seed,dim,threshold,tile", [(1, 24, 0.9, 4096), (2, 64, 0.9, 40), (3, 3, 0.97, 17), (4, 40, 0.5, 64)])
def test_matches_brute_force(spark, seed, dim, threshold, tile):
    rows = corpus(seed, dim)
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cid", F.lit("x"))
    got = E.near_duplicates(t, threshold, tile)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()), key=repr)
    assert got == brute(rows, threshold)


def test_empty_table(spark):
    t = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(t).count() == 0


def test_double_vectors_are_decided_in_double(spark):
    # cosines of 0.9 +- 1e-10 with (1, 0), which single precision cannot tell apart
    rows = [(0, [1.0, 0.0])]
    for i, c in enumerate((0.9 + 1e-10, 0.9 - 1e-10), 1):
        rows.append((i, [c, float(np.sqrt(1 - c * c)) * (1 if i == 1 else -1)]))
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.near_duplicates(t, 0.9).collect())
    assert got == [(0, 1, 0), (1, 1, 0), (2, 0, 2)]
