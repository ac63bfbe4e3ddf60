"""Landing -> typing job -> curated Parquet -> models: the whole flow of the
reference, checked against the models built straight from the driver tables."""

import pytest
from pyspark.sql import functions as F

from stayline.plans.models import Models
from stayline.sources import ingest as I
from stayline.sources.driver import landed

SIX = ["patients", "encounters", "conditions", "medications", "procedures", "observations"]


def test_csv_to_features(spark, sf_small, tmp_path):
    root = str(tmp_path)
    for t in SIX:
        I.write_landed_csv(landed(spark, sf_small, t), f"{root}/landing/{t}.csv")
        I.ingest(spark, t, f"{root}/landing/{t}.csv", f"{root}/curated/{t}")
    via_files = Models.from_paths(spark, f"{root}/curated").episode_features
    direct = Models.from_driver(spark, sf_small).episode_features
    assert dict(via_files.dtypes)["admitted_at"] == "timestamp"   # typed CSV gives instants
    a = sorted(tuple(r) for r in via_files.collect())
    b = sorted(tuple(r) for r in direct.collect())
    assert len(a) == 836 and a == b


def test_typed_read_aborts_on_bad_cell_and_header(spark, tmp_path):
    good = "Id,BIRTHDATE,DEATHDATE\n"
    p1 = tmp_path / "bad_cell"
    p1.mkdir()
    (p1 / "patients.csv").write_text(
        "Id,BIRTHDATE,DEATHDATE,SSN,DRIVERS,PASSPORT,PREFIX,FIRST,MIDDLE,LAST,SUFFIX,MAIDEN,"
        "MARITAL,RACE,ETHNICITY,GENDER,BIRTHPLACE,ADDRESS,CITY,STATE,COUNTY,FIPS,ZIP,LAT,LON,"
        "HEALTHCARE_EXPENSES,HEALTHCARE_COVERAGE,INCOME\n"
        "p1,not-a-date,,,,,,,,,,,,,,F,,,,,,,01086,1.0,2.0,1.00,2.00,5\n")
    with pytest.raises(Exception, match="MALFORMED|CSV header|FAILED_READ|schema"):
        I.read_typed_csv(spark, str(p1), "patients").collect()
    p2 = tmp_path / "bad_header"
    p2.mkdir()
    (p2 / "patients.csv").write_text(good + "p1,2000-01-01,\n")
    with pytest.raises(Exception, match="MALFORMED|CSV header|FAILED_READ|schema"):
        I.read_typed_csv(spark, str(p2), "patients").collect()
    with pytest.raises(ValueError):
        I.read_typed_csv(spark, str(p2), "allergies")


def test_zip_keeps_leading_zero_and_identifiers_dropped(spark, sf_small, tmp_path):
    root = str(tmp_path)
    I.write_landed_csv(landed(spark, sf_small, "patients"), f"{root}/patients.csv")
    cur = I.curate(I.read_typed_csv(spark, f"{root}/patients.csv", "patients"), "patients")
    assert "SSN" not in cur.columns and "ZIP" not in cur.columns and "LAT" not in cur.columns
    z = {r[0] for r in cur.select("ZIP3").distinct().collect()}
    assert "000" in z and all(len(x) == 3 for x in z)


def test_load_report_counts_rows(spark, sf_small, tmp_path):
    src = landed(spark, sf_small, "encounters").select("Id", "PATIENT")
    src.write.parquet(str(tmp_path / "in"))
    inc = spark.read.parquet(str(tmp_path / "in"))
    loaded = I.load_by_name(None, inc.withColumn("file", F.col("_metadata.file_path")),
                            [("Id", "string"), ("PATIENT", "string"), ("file", "string")])
    rep = I.load_report(inc, loaded).collect()
    assert rep and all(r["status"] == "LOADED" for r in rep)
    assert sum(r["rows_loaded"] for r in rep) == inc.count()


def test_pipeline_runs_end_to_end(spark, sf_small, tmp_path):
    from stayline.pipeline import run_pipeline
    landing = str(tmp_path / "landing")
    for t in SIX:
        I.write_landed_csv(landed(spark, sf_small, t), f"{landing}/{t}.csv")
    keep = {k: spark.conf.get(k) for k in ["spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.files.maxPartitionBytes"]}
    try:
        res = run_pipeline(spark, landing, str(tmp_path / "out"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"  # sized from input
        assert {r["status"] for r in res["gate"].collect()} == {"ACCEPTED"}
        feats = spark.read.parquet(res["layers"]["episode_features"])
        assert feats.count() == 836
        rep = res["dq_report"].collect()
        assert len(rep) == 50 and all(r["status"] == "PASS" for r in rep)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_append_by_name_aborts_on_a_bad_value(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    cols = [("Id", "string"), ("N", "int")]
    spark.createDataFrame([("1", "a"), ("2", "b")], "n string, id string").write.parquet(src)
    assert I.append_by_name(spark, src, dst, cols).first().asDict() == {
        "rows_before": 0, "rows_parsed": 2, "rows_loaded": 2, "status": "LOADED"}
    spark.createDataFrame([("x", "c")], "n string, id string").write.mode("overwrite").parquet(src)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        I.append_by_name(spark, src, dst, cols)
    assert spark.read.parquet(dst).count() == 2


def test_lookup_of_a_given_encounter_is_pushed_down(spark, sf_small, tmp_path):
    from stayline.plans.models import Models
    from stayline.plans.q_profile import encounter_by_id

    driver = Models.from_driver(spark, sf_small)
    path = str(tmp_path / "encounters")
    driver.source("encounters").write.parquet(path)
    m = Models(lambda t: spark.read.parquet(path))
    some = driver.encounters.select(F.max("encounter_id")).first()[0]
    got = encounter_by_id(m, some)
    assert [r.encounter_id for r in got.collect()] == [some]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(Id,{some})" in plan
