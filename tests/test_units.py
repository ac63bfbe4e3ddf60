"""Small rules pinned directly."""

from pyspark.sql import functions as F

from stayline.functions import pct, split_csv_line
from stayline.plans.layers import schema_name
from stayline.session import tune_for_input


def test_schema_name_rule():
    assert schema_name(None) == "CORE"
    assert schema_name("  feature_store ") == "FEATURE_STORE"


def test_tune_for_input(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.files.maxPartitionBytes"]
    keep = {k: spark.conf.get(k) for k in keys}
    try:
        assert tune_for_input(spark, 10 ** 12)["spark.sql.shuffle.partitions"] == "3726"
        assert tune_for_input(spark, 10 ** 6)["spark.sql.shuffle.partitions"] == "200"
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_split_csv_line(spark):
    df = spark.createDataFrame([('Id,"A, B","say ""hi""",,Z',)], "line string")
    assert df.select(split_csv_line("line")).first()[0] == ["Id", "A, B", 'say "hi"', "", "Z"]


def test_pct_rounds_half_up_in_tenths(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 0), (1, 16)], "a long, b long")
    got = [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()]
    assert got == [12.5, 33.3, 66.7, None, 6.3]
