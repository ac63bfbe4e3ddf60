import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import ann
from stayline.llm.queries import Q


def brute(rows, k, is_query):
    good = {}
    for i, v in rows:
        if i is None or v is None or len(v) == 0 or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for q in filter(is_query, good):
        d = sorted((float(np.sqrt(((good[q] - x) ** 2).sum())), i) for i, x in good.items()
                   if i != q and len(x) == len(good[q]))
        out[q] = d[:k]
    return out


def test_every_shard_is_searched_and_merged(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(900)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # copies of a query
    rows += [(2000, None), (2100, [0.0] * 12), (2200, [float("nan")] * 12), (2300, [None] * 12), (2400, []),
             (2500, [1.0, 2.0]), (None, rows[5][1])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(t, F.col("vec_id") % 100 == 0, k=10, shard_rows=200)
    want = brute(rows, 10, lambda i: i % 100 == 0)
    by = {}
    for r in got.collect():
        by.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    hit = total = 0
    for q, near in want.items():
        mine = sorted(by.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(near) + 1))
        assert [(s, i) for _, s, i in mine] == sorted((s, i) for _, s, i in mine)
        hit += len({i for _, _, i in mine} & {i for _, i in near})
        total += len(near)
    assert hit / total >= 0.97
    assert [i for _, _, i in sorted(by[100])] == list(range(1000, 1010))


def test_empty_table_and_few_candidates(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert ann.nearest(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], None)], schema)
    got = ann.nearest(few, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_recall_on_the_table(spark, sf):
    t = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in t.collect()]
    want = brute(rows, 10, lambda i: i % 100 == 0)
    got = {}
    for r in Q["op6_hnsw_search"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(got[q] & {i for _, i in near}) for q, near in want.items())
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_index_moves_once_whatever_the_number_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i + 2 ** 60, [float(x) for x in rng.normal(size=8 if i % 3 else 5)]) for i in range(400)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>")

    def near():
        df = ann.nearest(t, F.col("vec_id") % 4 == 0, k=5, shard_rows=60)
        return df, sorted(map(tuple, df.collect()))
    _, want = near()
    monkeypatch.setattr(ann, "BLOCK", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df, got = near()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len({r[0] for r in got}) == 100
    assert "explode" not in df._jdf.queryExecution().optimizedPlan().toString()
