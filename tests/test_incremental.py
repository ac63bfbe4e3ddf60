"""Exactly-once incremental loads and the deliberate reload."""

from stayline.sources.driver import curated
from stayline.streaming.incremental import load_new_files, reload_all


def test_incremental_then_reload(spark, sf_small, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    df = curated(spark, sf_small, "patients")
    n = df.count()
    df.limit(10).write.parquet(src + "/part1")
    schema = spark.read.parquet(src + "/part1").schema
    assert load_new_files(spark, src + "/*", schema, tgt, str(tmp_path / "ck1")) == 1
    assert load_new_files(spark, src + "/*", schema, tgt, str(tmp_path / "ck1")) == 0
    df.write.parquet(src + "/part2")                  # a new file arrives
    load_new_files(spark, src + "/*", schema, tgt, str(tmp_path / "ck1"))
    assert spark.read.parquet(tgt).count() == 10 + n
    # deliberate reload: replace everything, new log
    assert reload_all(spark, src + "/*", schema, tgt, str(tmp_path / "ck2")) == 10 + n
    assert load_new_files(spark, src + "/*", schema, tgt, str(tmp_path / "ck2")) == 0
    assert spark.read.parquet(tgt).count() == 10 + n
