"""The blocked (skew-safe) scan must equal a plain window over the key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayline.operators import scan as S
from stayline.operators.intervals import number_islands
from stayline.session import materialize


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key with most rows, a few cold keys, and NULL keys/values
        k = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c", None])
        day = rnd.randint(0, 2000)
        v = None if rnd.random() < 0.1 else rnd.randint(-50, 50)
        rows.append((k, i, day, v))
    df = spark.createDataFrame(rows, "k string, id long, day int, v int")
    return df.withColumn("t", F.date_add(F.lit("2000-01-01").cast("date"), F.col("day")))


def test_blocked_scan_matches_window(spark, blocked):
    df = _frame(spark)
    order = S.asc("t", "id")
    specs = [S.Spec("mx_before", "max", "v", "before"), S.Spec("sum_upto", "sum", "v", "upto"),
             S.Spec("mn_after", "min", "v", "after"), S.Spec("sum_from", "sum", "v", "from")]
    got = S.ordered_scan(df, ["k"], order, specs)
    w = Window.partitionBy("k").orderBy(*S.asc_nulls_last(*order))
    exp = df.select(
        "id",
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mx_before"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sum_upto"),
        F.min("v").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("mn_after"),
        F.sum("v").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("sum_from"))
    g = {r["id"]: r for r in got.select("id", "mx_before", "sum_upto", "mn_after", "sum_from")
         .collect()}
    for r in exp.collect():
        a = g[r["id"]]
        assert a["mx_before"] == r["mx_before"]
        assert a["sum_upto"] == r["sum_upto"]
        assert a["mn_after"] == r["mn_after"]
        assert a["sum_from"] == r["sum_from"]


def test_scan_plan_keeps_big_side_in_place(spark, blocked):
    """The carry join must not re-shuffle the windowed rows by key alone."""
    df = _frame(spark, n=200)
    got = S.ordered_scan(df, ["k"], S.asc("t", "id"), [S.Spec("m", "max", "v", "before")],
                         materialize=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_islands_hot_patient_matches_window(spark, blocked):
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        p = "P0" if i % 3 else f"P{i % 17}"
        start = 1_000_000 + rnd.randint(0, 400) * 86400 + rnd.randint(0, 86399)
        stop = start + rnd.randint(-3600, 10 * 86400) if rnd.random() > 0.05 else None
        rows.append((p, f"e{i}", start, stop))
    df = spark.createDataFrame(rows, "p string, eid string, s long, t long").select(
        "p", "eid", F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("t").alias("t"))
    got = number_islands(df, "p", "s", "t", "eid")
    w = Window.partitionBy("p").orderBy(*S.asc_nulls_last("s", "t", "eid"))
    ref = df.withColumn("pm", F.max("t").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    ref = ref.withColumn("nw", F.when(F.col("pm").isNull()
                                      | (F.datediff(F.to_date("s"), F.to_date("pm")) > 0), 1)
                         .otherwise(0))
    ref = ref.withColumn("num", F.sum("nw").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    a = {r["eid"]: (r["prev_max_end"], r["island_number"]) for r in got.collect()}
    for r in ref.collect():
        assert a[r["eid"]] == (r["pm"], r["num"]), r


def test_auto_mode_switches_on_a_hot_key(spark):
    """With a tiny per-key limit the hot key forces the blocked scan; the
    answers are the same either way."""
    df = _frame(spark, n=600)
    order = S.asc("t", "id")
    specs = [S.Spec("m", "max", "v", "before")]
    spark.conf.set("stayline.scan.maxRowsPerKey", "10")
    try:
        got = S.ordered_scan(df, ["k"], order, specs)
        assert "__cb" in got._jdf.queryExecution().analyzed().toString()
        a = {r["id"]: r["m"] for r in got.collect()}
    finally:
        spark.conf.unset("stayline.scan.maxRowsPerKey")
    plain = S.ordered_scan(df, ["k"], order, specs)
    assert "__cb" not in plain._jdf.queryExecution().analyzed().toString()
    assert a == {r["id"]: r["m"] for r in plain.collect()}


@pytest.mark.parametrize("crowd", ["one minute", "one instant", "no time", "no key", "equal rows"])
def test_any_crowd_is_split(spark, crowd):
    """One key's rows within a minute, at one instant, without a time, without
    a key, or equal in all columns: no block exceeds the limit, and the answers
    equal the plain window's."""
    import datetime as dt
    t0, n = dt.datetime(2020, 1, 1), 900
    rows = [("hot" if crowd != "no key" else None, 0 if crowd == "equal rows" else i,
             {"one minute": t0 + dt.timedelta(milliseconds=60 * i), "no key": t0 + dt.timedelta(days=i % 7),
              "no time": None}.get(crowd, t0), 1 if crowd == "equal rows" else i % 13) for i in range(n)]
    rows += [("cold", 10_000 + i, t0, i) for i in range(5)] + [(None, 20_000, None, 5)]
    df = spark.createDataFrame(rows, "k string, id long, t timestamp, v int")
    order = S.asc("t", "id")
    specs = [S.Spec("s", "sum", "v", "upto"), S.Spec("b", "max", "v", "before"), S.Spec("a", "min", "v", "after")]
    w = Window.partitionBy("k").orderBy(*S.asc_nulls_last(*order))
    rev = Window.partitionBy("k").orderBy(F.col("t").desc_nulls_first(), F.col("id").desc())
    ref = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b"),
                    F.min("v").over(rev.rowsBetween(Window.unboundedPreceding, -1)).alias("a"))
    spark.conf.set("stayline.scan.maxRowsPerKey", "100")
    try:
        p = S.prepare(df, ["k"])
        blocks = S.in_blocks(materialize(p), ["__scan_k0"], order)
        most = blocks.groupBy("__scan_k0", S.BLK).count().agg(F.max("count")).first()[0]
        assert most <= 100
        got = S.ordered_scan(df, ["k"], order, specs)
        key = lambda r: tuple((x is None, x) for x in r)
        a = sorted(map(tuple, got.select("id", "s", "b", "a").collect()), key=key)
    finally:
        spark.conf.unset("stayline.scan.maxRowsPerKey")
    b = sorted(map(tuple, ref.collect()), key=key)
    if crowd == "equal rows":  # which of them comes first is free: column by column
        a, b = ([sorted(c, key=lambda x: (x is None, x)) for c in zip(*rows)] for rows in (a, b))
    assert a == b


def test_blocks_are_contiguous_in_the_order(spark):
    df = S.prepare(_frame(spark), ["k"])
    spark.conf.set("stayline.scan.maxRowsPerKey", "200")
    try:
        b = S.in_blocks(materialize(df), ["__scan_k0"], S.asc("t", "id"))
        w = Window.partitionBy("__scan_k0").orderBy(*S.asc_nulls_last("t", "id"))
        assert b.withColumn("back", F.col(S.BLK) < F.lag(S.BLK).over(w)).where("back").count() == 0
        assert b.select(S.BLK).distinct().count() > 20
    finally:
        spark.conf.unset("stayline.scan.maxRowsPerKey")


def test_models_with_a_hot_patient_auto_switch(spark, sf_small):
    """A third of all encounters (and the records derived from them) moved to
    one patient: auto mode detects it under a small per-task limit, runs the
    two-level scans with adaptive blocks, and matches the plain windows."""
    from stayline.plans.models import Models
    from stayline.sources.driver import DriverSources

    src = DriverSources(spark, sf_small)

    def raw(t):
        df = src.raw(t)
        if t in ("encounters", "conditions", "procedures"):
            enc = "Id" if t == "encounters" else "ENCOUNTER"
            hot = (F.col(enc).cast("bigint") % 3) == 0
            df = df.withColumn("PATIENT", F.when(hot, F.lit("1")).otherwise(F.col("PATIENT")))
        return df

    cols = ["episode_id", "stay_in_episode", "prior_episodes", "prior_episodes_365d",
            "active_disorders_at_discharge", "readmitted_30d", "age_at_admission"]
    spark.conf.set("stayline.scan.mode", "window")
    try:
        plain = sorted(tuple(r) for r in Models(raw).episode_features.select(*cols).collect())
    finally:
        spark.conf.unset("stayline.scan.mode")
    spark.conf.set("stayline.scan.maxRowsPerKey", "200")
    try:
        m = Models(raw)
        assert m.rows_per_patient["encounters"] > 200     # the hot patient is seen
        auto = sorted(tuple(r) for r in m.episode_features.select(*cols).collect())
    finally:
        spark.conf.unset("stayline.scan.maxRowsPerKey")
    assert auto == plain and len(plain) > 0


def test_feature_layout_counts_all_timeline_rows(spark, monkeypatch):
    """Parts of the layout follow the rows that meet in them, disorders too;
    an episode table laid out in fewer parts is dealt anew."""
    import datetime as dt

    from stayline.operators import layout

    from .rawframes import inpatient, models_from, patient

    def models():
        return models_from(
            spark, [patient(str(p)) for p in range(5)],
            [inpatient(f"e{p}", str(p), "2020-02-01", "2020-02-05") for p in range(5)],
            [{"PATIENT": str(i % 5), "CODE": str(i), "DESCRIPTION": "x (disorder)", "START": dt.date(2020, 1, 1),
              "STOP": dt.date(2020, 1, 15) + dt.timedelta(days=i)} for i in range(40)])

    def counts(m):
        return sorted((r.patient_id, r.active_disorders_at_discharge) for r in m.episode_features.collect())

    few = counts(models())
    assert sum(n for _, n in few) == 19  # those that stop on 5 February or later: i >= 21
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 10)
    together, apart = models(), models()
    assert counts(together) == few and together.buckets == together._feature_buckets == (3 * 40 + 4 * 5) // 10
    apart.inpatient_episodes.count()
    assert apart.buckets < apart._feature_buckets == 14 and counts(apart) == few
