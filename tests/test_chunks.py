"""Ordered arrays in chunks hold every row once, in order, in bounded arrays."""

import pytest

from stayline.operators.chunks import ordered_chunks


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_chunks_are_the_whole_history(spark, size):
    rows = [(k, i + 1, f"{k}-{i}") for k, n in (("a", 13), ("b", 4), (None, 5), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, pos long, v string").repartition(3)
    got = ordered_chunks(df, ["k"], "pos", ["v", "pos"], size).collect()
    assert all(len(r["items"]) <= size for r in got)
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in got if r["k"] == key), key=lambda r: r["chunk"])
        assert [r["chunk"] for r in mine] == list(range(len(mine)))
        assert [(i["pos"], i["v"]) for r in mine for i in r["items"]] == [(p, v) for k, p, v in rows if k == key]


def test_empty_and_refused(spark):
    df = spark.createDataFrame([], "k string, pos long, v string")
    assert ordered_chunks(df, ["k"], "pos", ["v"], 3).count() == 0
    with pytest.raises(ValueError):
        ordered_chunks(df, ["k"], "pos", ["v"], 0)
