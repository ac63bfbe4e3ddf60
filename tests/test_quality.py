"""Each data-quality check finds its planted defect (FIXTURES.md §6) and
passes on clean driver data."""

from stayline.plans import q_checks as C
from stayline.plans.models import Models
from tests.rawframes import inpatient, models_from, patient


def _viol(df, **match):
    rows = [r.asDict() for r in df.collect()]
    return sum(r["violations"] for r in rows if all(r.get(k) == v for k, v in match.items()))


def test_planted_defects(spark):
    pats = [patient("p1"), patient("p2"), patient("p2"), patient("p3", zip3=None),
            patient(None)]
    encs = [inpatient("A", "p1", "2020-01-01T08:00", "2020-01-02T08:00"),
            inpatient("A", "p1", "2020-03-01T08:00", "2020-03-02T08:00"),   # duplicate id
            inpatient("B", "zz", "2020-01-01T08:00", "2020-01-02T08:00"),   # orphan patient
            inpatient("C", None, "2020-01-01T08:00", "2020-01-02T08:00"),   # NULL key
            inpatient("D", "p3", "2020-01-05T08:00", "2020-01-04T08:00")]   # stop < start
    m = models_from(spark, patients=pats, encounters=encs)
    nn = C.not_null_rows(m)
    assert _viol(nn, model="encounters", column_name="patient_id") == 1
    assert _viol(nn, model="patients", column_name="patient_id") == 1
    un = C.unique_rows(m)
    assert _viol(un, model="encounters", column_name="encounter_id") == 1
    assert _viol(un, model="patients", column_name="patient_id") == 1
    rel = C.relationship_rows(m)
    assert _viol(rel, model="encounters", column_name="patient_id") == 1
    checks = C.singular_checks(m)
    assert checks["encounters_no_negative_stay"]().count() == 1
    assert checks["patients_geo_consistency"]().count() == 1


def test_clean_fixture_passes(spark, sf_small):
    m = Models.from_driver(spark, sf_small)
    rep = C.Q["dq_report"](spark, sf_small).collect()
    assert len(rep) == 50
    failing = {r["check_name"] for r in rep if r["violations"] != 0}
    assert failing == set(), failing
    assert m.episode_features.count() == 836


def test_planted_defects_in_model_outputs(spark, sf_small):
    """Checks on episodes and features fire on planted defects (FIXTURES §6)."""
    from pyspark.sql import functions as F
    m = Models.from_driver(spark, sf_small)
    e, f = m.inpatient_episodes, m.episode_features
    one = F.col("episode_id") == F.lit(e.orderBy("episode_id").first()["episode_id"])
    e_bad = (e.withColumn("readmitted_30d", F.when(one, F.lit(True)).otherwise(F.col("readmitted_30d")))
              .withColumn("days_to_next_admission",
                          F.when(one, F.lit(31)).otherwise(F.col("days_to_next_admission")))
              .withColumn("is_planned_readmission",
                          F.when(one, F.lit(True)).otherwise(F.col("is_planned_readmission")))
              .withColumn("unplanned_readmitted_30d",
                          F.when(one, F.lit(True)).otherwise(F.col("unplanned_readmitted_30d"))))
    fid = f.orderBy("episode_id").first()["episode_id"]
    hit = F.col("episode_id") == F.lit(fid)
    f_bad = (f.withColumn("prior_episodes_365d",
                          F.when(hit, F.col("prior_episodes") + 10)
                          .otherwise(F.col("prior_episodes_365d")))
              .withColumn("prior_episodes",
                          F.when(hit, F.col("prior_episodes") + 5).otherwise(F.col("prior_episodes")))
              .withColumn("age_at_admission",
                          F.when(hit, F.lit(121)).otherwise(F.col("age_at_admission")))
              .filter(F.col("episode_id") != F.lit(f.orderBy(F.desc("episode_id")).first()[0])))
    m.__dict__["inpatient_episodes"] = e_bad
    m.__dict__["episode_features"] = f_bad
    checks = C.singular_checks(m)
    for name in ["episodes_planned_unplanned_split", "episodes_readmission_window",
                 "features_365d_within_all_time", "features_prior_episodes_match",
                 "features_valid_ranges"]:
        assert checks[name]().count() >= 1, name
    rc = {r["check_name"]: r["violations"] for r in C.row_count_checks(m).collect()}
    assert rc["features_row_count"] == 1          # one feature row removed
