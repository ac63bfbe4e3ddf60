"""Timeline sweeps against brute force: for random queries and points, the
next point at or after each query time and the number of points strictly
before it (the EXISTS and range-count joins they replace)."""

import datetime as dt
import random

import pytest

from stayline.operators.sweep import sweep

BASE = dt.datetime(2020, 1, 1)


def _data(seed):
    rnd = random.Random(seed)
    def t():
        return None if rnd.random() < 0.05 else BASE + dt.timedelta(hours=rnd.randint(0, 2000))
    keys = ["a", "b", "c", None]
    q = [(rnd.choice(keys), i, t()) for i in range(300)]
    p = [(rnd.choice(keys), t()) for _ in range(400)]
    # ties between queries and points at the same instant
    p += [(k, ts) for k, _, ts in q[:40]]
    return q, p


def _brute(q, p):
    out = {}
    for k, i, ts in q:
        if k is None or ts is None:
            pts = [] if k is None else [x for kk, x in p if kk == k and x is not None]
            nxt = None
            before = sum(1 for x in pts if ts is not None and x < ts)
        else:
            pts = [x for kk, x in p if kk == k and x is not None]
            later = [x for x in pts if x >= ts]
            nxt = min(later) if later else None
            before = sum(1 for x in pts if x < ts)
        out[i] = (nxt, before)
    return out


@pytest.mark.parametrize("mode", ["window", "blocked"])
def test_sweep_matches_brute_force(spark, mode):
    q, p = _data(11)
    qdf = spark.createDataFrame(q, "k string, i long, ts timestamp_ntz")
    pdf = spark.createDataFrame(p, "k string, ts timestamp_ntz")
    spark.conf.set("stayline.scan.mode", mode)
    try:
        got = sweep(["k"], ["i"], {"q": qdf}, {"p": pdf},
                    [("nxt", "p", "next"), ("before", "p", "count_before")]).collect()
    finally:
        spark.conf.unset("stayline.scan.mode")
    want = _brute(q, p)
    for r in got:
        nxt, before = want[r["i"]]
        assert r["nxt"] == nxt, (r, nxt)
        if r["ts"] is not None:
            assert r["before"] == before, (r, before)
    assert len(got) == len(q)
