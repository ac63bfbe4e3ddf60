"""Hand-made micro cases with answers fixed by the rules (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from stayline.functions import age_years
from tests.rawframes import by_key, d, inpatient, models_from, patient, ts


def _episodes(spark, encs, pats=None, procs=(), conds=()):
    pats = pats or [patient("p1")]
    m = models_from(spark, patients=pats, encounters=encs, procedures=procs, conditions=conds)
    return m, by_key(m.inpatient_episodes)


def test_nested_stay_merges(spark):
    _, e = _episodes(spark, [inpatient("A", "p1", "2020-01-01T08:00", "2020-01-20T08:00"),
                             inpatient("B", "p1", "2020-01-03T08:00", "2020-01-05T08:00"),
                             inpatient("C", "p1", "2020-01-15T08:00", "2020-01-25T08:00")])
    assert list(e) == ["p1-1"]
    assert e["p1-1"]["stay_in_episode"] == 3
    assert e["p1-1"]["discharged_at"] == ts("2020-01-25T08:00")


def test_same_day_transfer_and_midnight_gap(spark):
    _, e = _episodes(spark, [inpatient("A", "p1", "2020-01-01T08:00", "2020-01-02T10:00"),
                             inpatient("B", "p1", "2020-01-02T18:00", "2020-01-03T23:50"),
                             inpatient("C", "p1", "2020-01-04T00:10", "2020-01-05T00:10")])
    assert sorted(e) == ["p1-1", "p1-2"]
    assert e["p1-1"]["stay_in_episode"] == 2
    assert e["p1-1"]["days_to_next_admission"] == 1 and e["p1-1"]["readmitted_30d"] is True
    last = e["p1-2"]
    assert last["readmitted_30d"] is False and last["days_to_next_admission"] is None


def test_gap_30_and_31(spark):
    _, e = _episodes(spark, [inpatient("A", "p1", "2020-01-01T08:00", "2020-01-02T08:00"),
                             inpatient("B", "p1", "2020-02-01T08:00", "2020-02-02T08:00"),
                             inpatient("C", "p1", "2020-03-04T08:00", "2020-03-05T08:00")])
    assert e["p1-1"]["days_to_next_admission"] == 30 and e["p1-1"]["readmitted_30d"]
    assert e["p1-2"]["days_to_next_admission"] == 31 and not e["p1-2"]["readmitted_30d"]


def test_death_boundaries(spark):
    enc = [inpatient("A", "p1", "2020-01-10T08:00", "2020-01-12T08:00")]
    cases = {"2020-01-09": (True, False), "2020-01-10": (False, True),
             "2020-01-13": (False, True), "2020-01-14": (False, False)}
    for death, (before, died) in cases.items():
        _, e = _episodes(spark, enc, [patient("p1", death=death)])
        r = e["p1-1"]
        assert (r["death_before_admission"], r["died_in_episode"]) == (before, died), death
        assert r["is_eligible_index"] == (not before and not died)


def test_hospice_window(spark):
    base = [inpatient("A", "p1", "2020-01-10T08:00", "2020-01-12T08:00")]
    for start, want in [("2020-01-12T08:00", True), ("2020-01-13T08:00", True),
                        ("2020-01-13T08:00:01", False)]:
        _, e = _episodes(spark, base + [inpatient("H", "p1", start, "2020-01-20T08:00", "hospice")])
        assert e["p1-1"]["discharged_to_hospice"] is want, start


def test_planned_readmission(spark):
    enc = [inpatient("A", "p1", "2020-01-01T08:00", "2020-01-02T08:00"),
           inpatient("B", "p1", "2020-01-10T08:00", "2020-01-12T08:00")]
    procs = [{"START": ts("2020-01-10T08:00"), "PATIENT": "p1", "ENCOUNTER": "B",
              "CODE": "x", "DESCRIPTION": "CHEMOTHERAPY session"}]
    _, e = _episodes(spark, enc, procs=procs)
    assert e["p1-1"]["is_planned_readmission"] is True
    assert e["p1-1"]["unplanned_readmitted_30d"] is False


def test_age_rule(spark):
    cases = [("1990-12-31", "2020-01-01", 29), ("1990-01-01", "2020-12-31", 30),
             ("1990-06-15", "2020-06-14", 29), ("1990-06-15", "2020-06-15", 30),
             ("1988-02-29", "2021-02-28", 32)]
    df = spark.createDataFrame([(d(b), d(a)) for b, a, _ in cases], "b date, a date")
    got = [r[0] for r in df.select(age_years("b", "a")).collect()]
    assert got == [c[2] for c in cases]


def test_history_365_and_ineligible(spark):
    # episodes 367 and 365 days before the last one; the middle one is
    # ineligible (discharged to hospice) but still counts as history
    enc = [inpatient("A", "p1", "2018-12-31T08:00", "2018-12-31T09:00"),
           inpatient("B", "p1", "2019-01-02T08:00", "2019-01-02T09:00"),
           inpatient("H", "p1", "2019-01-02T10:00", "2019-01-09T10:00", "hospice"),
           inpatient("C", "p1", "2020-01-02T08:00", "2020-01-03T08:00")]
    m, e = _episodes(spark, enc)
    assert e["p1-2"]["is_eligible_index"] is False
    f = by_key(m.episode_features)
    assert "p1-2" not in f
    assert f["p1-3"]["prior_episodes"] == 2
    assert f["p1-3"]["prior_episodes_365d"] == 1


def test_active_disorders_point_in_time(spark):
    enc = [inpatient("A", "p1", "2020-01-10T08:00", "2020-01-15T08:00")]
    conds = [
        {"START": d("2019-01-01"), "STOP": d("2020-01-15"), "PATIENT": "p1", "CODE": "c1",
         "DESCRIPTION": "x (disorder)"},                     # stops on discharge day: active
        {"START": d("2019-01-01"), "STOP": d("2020-01-14"), "PATIENT": "p1", "CODE": "c2",
         "DESCRIPTION": "x (disorder)"},                     # a day earlier: not active
        {"START": d("2019-01-01"), "STOP": None, "PATIENT": "p1", "CODE": "c3",
         "DESCRIPTION": "x (disorder)"},                     # open: active
        {"START": d("2019-06-01"), "STOP": None, "PATIENT": "p1", "CODE": "c3",
         "DESCRIPTION": "x (disorder)"},                     # same code twice: once
        {"START": d("2019-06-01"), "STOP": None, "PATIENT": "p1", "CODE": "c4",
         "DESCRIPTION": None},                               # NULL description: not counted
        {"START": d("2019-06-01"), "STOP": None, "PATIENT": "p1", "CODE": "c5",
         "DESCRIPTION": "x (finding)"},                      # not a disorder
    ]
    m, _ = _episodes(spark, enc, conds=conds)
    f = by_key(m.episode_features)
    assert f["p1-1"]["active_disorders_at_discharge"] == 2
    c = {r["condition_code"]: r["is_disorder"] for r in m.conditions.collect()}
    assert c["c4"] is None


def test_zip3_null_geo_known(spark):
    m = models_from(spark, patients=[patient("p1", zip3=None), patient("p2", zip3="000")])
    p = by_key(m.patients, "patient_id")
    assert p["p1"]["zip3"] is None and p["p1"]["geo_known"] is True
    assert p["p2"]["zip3"] is None and p["p2"]["geo_known"] is False


def test_value_num_malformed(spark):
    from stayline.sources.ingest import curate
    df = spark.createDataFrame([("abc", "numeric"), ("1.5", "numeric"), ("2", "text")],
                               "VALUE string, TYPE string")
    got = [r["VALUE_NUM"] for r in curate(df, "observations").orderBy(F.col("VALUE")).collect()]
    assert got == [1.5, None, None]


def test_models_equal_under_blocked_scans(spark, sf_small):
    """The flagship under the forced two-level scans equals the default run."""
    from stayline.plans.models import Models
    cols = ["episode_id", "prior_episodes", "prior_episodes_365d",
            "active_disorders_at_discharge", "readmitted_30d", "stay_in_episode"]
    base = sorted(tuple(r) for r in Models.from_driver(spark, sf_small)
                  .episode_features.select(*cols).collect())
    spark.conf.set("stayline.scan.mode", "blocked")
    try:
        blk = sorted(tuple(r) for r in Models.from_driver(spark, sf_small)
                     .episode_features.select(*cols).collect())
    finally:
        spark.conf.unset("stayline.scan.mode")
    assert base == blk and len(base) == 836


def test_null_patient_matches_nothing_in_sweeps(spark):
    """EXISTS / range joins never match NULL = NULL: an episode of a NULL
    patient finds no hospice encounter even if one has a NULL patient too."""
    from stayline.plans.episodes import hospice_and_chemo
    m = models_from(spark, patients=[patient("p1")],
                    encounters=[inpatient("A", None, "2020-01-10T08:00", "2020-01-12T08:00"),
                                inpatient("H", None, "2020-01-12T09:00", "2020-01-20T08:00",
                                          "hospice")])
    spans = m.episode_spans
    hc = hospice_and_chemo(spans, m.encounters, m.procedures).collect()
    assert len(hc) == 1 and hc[0]["next_hospice"] is None


def test_standalone_j5_equals_merged_timeline(spark, sf_small):
    """operators.intervals (islands + covering sweep) alone gives the same
    active-disorder counts as the merged feature timeline."""
    from pyspark.sql import functions as F

    from stayline.plans.features import active_disorders
    from stayline.plans.models import Models
    m = Models.from_driver(spark, sf_small)
    el = m.inpatient_episodes.filter(F.col("is_eligible_index"))
    a = {(r[0], r[1]): r[2] for r in active_disorders(el, m.conditions).collect()}
    b = {(r["patient_id"], r["episode_number"]): r["active_disorders_at_discharge"]
         for r in m.timeline.collect()}
    assert a == b and len(a) == 836


def test_boundary_semantics(spark):
    """Appendix A: differences count unit boundaries, not elapsed units."""
    from stayline.functions import day_diff, hour_diff, minute_diff, plus_days_keep_time
    rows = [(ts("2020-01-01T15:50:00"), ts("2020-01-01T16:05:00")),
            (ts("2020-01-01T15:27:00"), ts("2020-01-01T15:42:00")),
            (ts("2020-01-01T23:50:00"), ts("2020-01-02T00:10:00"))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(hour_diff("a", "b"), minute_diff("a", "b"), day_diff("a", "b"),
                    plus_days_keep_time("a", 1)).collect()
    assert [tuple(r)[:3] for r in got] == [(1, 15, 0), (0, 15, 0), (1, 20, 1)]
    assert got[2][3] == ts("2020-01-02T23:50:00")


def test_null_stop_does_not_absorb_next_stay(spark):
    """MAX ignores NULL: a first stay without a stop cannot chain the next."""
    _, e = _episodes(spark, [inpatient("A", "p1", "2020-01-01T08:00", None),
                             inpatient("B", "p1", "2020-01-05T08:00", "2020-01-06T08:00")])
    assert sorted(e) == ["p1-1", "p1-2"]
    assert e["p1-1"]["discharged_at"] is None


def test_history_boundary_365_366(spark):
    enc = [inpatient("A", "p1", "2019-01-01T08:00", "2019-01-01T09:00"),   # 366 days before C
           inpatient("B", "p1", "2019-01-02T08:00", "2019-01-02T09:00"),   # 365 days before C
           inpatient("C", "p1", "2020-01-02T08:00", "2020-01-03T08:00")]
    m, _ = _episodes(spark, enc)
    f = by_key(m.episode_features)
    assert f["p1-3"]["prior_episodes"] == 2 and f["p1-3"]["prior_episodes_365d"] == 1


def test_head_sample_stays_in_the_head(spark):
    from pyspark.sql import functions as F

    from stayline.plans.q_profile import head_sample

    rows = [(d, e, "a" if (3 * i) % 7 < 5 else "b") for i, (d, e) in
            enumerate((d, e) for d in (1, 2, None) for e in ("x", "y", None, "z"))]
    df = spark.createDataFrame(rows, "d int, e string, k string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    for head in (0, 1, 4, 7, 100):
        first = sorted(rows, key=key)[:head]
        want = [r for k in "ab" for r in [x for x in first if x[2] == k][:3]]
        got = head_sample(df, ["d", "e"], {k: F.col("k") == k for k in "ab"}, head)
        assert [tuple(r)[:3] for r in got.collect()] == want
