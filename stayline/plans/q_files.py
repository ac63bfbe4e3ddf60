"""Registered queries: landed files, typed ingest, loads, layers and the
file gate (batch and streaming).

Each query first lands its input from the driver tables into a fresh folder
under the session's shared checkpoint directory, then reads it back through
the operator under test, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import oracle as O
from ..session import scratch_dir
from ..sources import ingest as I
from ..sources.driver import curated, landed
from ..sources.schemas import REQUIRED_COLUMNS
from ..streaming import gate as G
from ..streaming.incremental import load_new_files
from .layers import materialize_layers
from .models import Models

Q: dict = {}
SQL: dict = {}


def q(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def _land(spark, sf, table: str, root: str | None = None) -> str:
    root = root or scratch_dir(spark, "landing")
    return I.write_landed_csv(landed(spark, sf, table), f"{root}/{table}.csv")


# --- typed ingest -------------------------------------------------------------------

@q("ingest_csv_typed")
def ingest_csv_typed(spark, sf):
    """Landed encounters read against the declared schema."""
    return I.read_typed_csv(spark, _land(spark, sf, "encounters"), "encounters")


SQL["ingest_csv_typed"] = "SELECT * FROM (" + O.landed("encounters") + ") t"


@q("ingest_csv_untyped")
def ingest_csv_untyped(spark, sf):
    """The same file with every column as text."""
    return I.read_untyped_csv(spark, _land(spark, sf, "encounters"))


def _untyped_sql() -> str:
    from ..sources.schemas import SCHEMAS
    cols = []
    for f in SCHEMAS["encounters"].fields:
        t = f.dataType.simpleString()
        if t == "timestamp":
            cols.append(f"strftime(\"{f.name}\", '%Y-%m-%dT%H:%M:%SZ') AS \"{f.name}\"")
        else:
            cols.append(f"CAST(\"{f.name}\" AS VARCHAR) AS \"{f.name}\"")
    return f"SELECT {', '.join(cols)} FROM ({O.landed('encounters')}) t"


SQL["ingest_csv_untyped"] = _untyped_sql()


@q("ingest_patients_deidentified")
def ingest_patients_deidentified(spark, sf):
    """Typed patients, ZIP -> ZIP3, direct identifiers dropped."""
    df = I.read_typed_csv(spark, _land(spark, sf, "patients"), "patients")
    return I.curate(df, "patients")


SQL["ingest_patients_deidentified"] = O.with_models("SELECT * FROM raw_patients")


@q("ingest_observations_value_num")
def ingest_observations_value_num(spark, sf):
    """Numeric copy of VALUE only where TYPE is numeric."""
    df = I.read_typed_csv(spark, _land(spark, sf, "observations"), "observations")
    return I.curate(df, "observations")


# the landed format carries whole seconds
SQL["ingest_observations_value_num"] = O.with_models(
    "SELECT * REPLACE (date_trunc('second', \"DATE\") AS \"DATE\") FROM raw_observations")


@q("curated_roundtrip")
def curated_roundtrip(spark, sf):
    """K1: the typing job end to end (CSV -> curated Parquet, overwrite) and
    the curated dataset read back."""
    src = _land(spark, sf, "medications")
    dst = scratch_dir(spark, "curated") + "/medications"
    I.ingest(spark, "medications", src, dst)
    I.ingest(spark, "medications", src, dst)  # full refresh: a re-run overwrites
    return spark.read.parquet(dst)


SQL["curated_roundtrip"] = O.with_models("SELECT * FROM raw_medications")


@q("load_by_name")
def load_by_name(spark, sf):
    """A dataset whose columns are lower-cased and in another order is
    loaded into the target layout by case-insensitive name."""
    src = curated(spark, sf, "conditions")
    target_cols = [(f.name, f.dataType.simpleString()) for f in src.schema.fields]
    shuffled = src.select(*[F.col(c).alias(c.lower()) for c in reversed(src.columns)])
    path = scratch_dir(spark, "incoming") + "/conditions"
    shuffled.write.mode("overwrite").parquet(path)
    return I.load_by_name(None, spark.read.parquet(path), target_cols)


SQL["load_by_name"] = O.with_models("SELECT * FROM raw_conditions")


@q("load_append_report")
def load_append_report(spark, sf):
    """Procedures loaded by name into a new target and once more into the
    target that now holds them; one report row per load."""
    src = curated(spark, sf, "procedures")
    root = scratch_dir(spark, "append")
    src.select(*[F.col(c).alias(c.lower()) for c in reversed(src.columns)]).write.parquet(f"{root}/src")
    first = I.append_by_name(spark, f"{root}/src", f"{root}/target", src.dtypes)
    again = I.append_by_name(spark, f"{root}/src", f"{root}/target", src.dtypes)
    return first.withColumn("load_no", F.lit(1)).unionByName(again.withColumn("load_no", F.lit(2)))


SQL["load_append_report"] = O.with_models(
    "SELECT i AS load_no, CAST((i - 1) * n AS BIGINT) AS rows_before, n AS rows_parsed, n AS rows_loaded, "
    "'LOADED' AS status FROM (SELECT count(*) AS n FROM raw_procedures) p, (VALUES (1), (2)) v(i)")


@q("incremental_load_once")
def incremental_load_once(spark, sf):
    """Loading the same files twice adds them once."""
    src_df = curated(spark, sf, "encounters")
    root = scratch_dir(spark, "incremental")
    src_df.write.mode("overwrite").parquet(f"{root}/src")
    schema = spark.read.parquet(f"{root}/src").schema
    load_new_files(spark, f"{root}/src", schema, f"{root}/target", f"{root}/_checkpoint")
    again = load_new_files(spark, f"{root}/src", schema, f"{root}/target", f"{root}/_checkpoint")
    if again:
        raise AssertionError(f"re-run loaded {again} batches")
    return spark.read.parquet(f"{root}/target")


SQL["incremental_load_once"] = O.with_models("SELECT * FROM raw_encounters")


@q("materialize_layers")
def materialize_layers_q(spark, sf):
    """K5: models written as full-refresh tables per layer; the feature
    layer read back."""
    root = scratch_dir(spark, "warehouse")
    paths = materialize_layers(Models.from_driver(spark, sf), root)
    return spark.read.parquet(paths["episode_features"])


SQL["materialize_layers"] = O.with_models(f"SELECT {O.FEATURE_COLS} FROM episode_features")


# --- the file gate ----------------------------------------------------------------------

def build_landing(spark, sf) -> str:
    """A landing folder with one case per verdict, all derived from the
    driver tables: valid files, a header with the key in other case, a
    missing column, a header-only file, a missing table, an untracked file
    and a copy under quarantine/."""
    root = scratch_dir(spark, "gate")
    I.write_landed_csv(landed(spark, sf, "encounters"), f"{root}/encounters.csv")
    I.write_landed_csv(landed(spark, sf, "observations").drop("VALUE"),
                       f"{root}/observations.csv")
    I.write_landed_csv(landed(spark, sf, "patients").withColumnRenamed("Id", "ID"),
                       f"{root}/patients.csv")
    I.write_landed_csv(landed(spark, sf, "procedures").filter(F.lit(False)),
                       f"{root}/procedures.csv")
    I.write_landed_csv(landed(spark, sf, "patients"), f"{root}/other.csv")
    I.write_landed_csv(landed(spark, sf, "patients"), f"{root}/quarantine/patients.csv")
    # conditions.csv and medications.csv never land: reported through the
    # expected-table list
    return root


def landed_keys(spark, root: str) -> DataFrame:
    """(key, landed) of the files the gate must judge, from the listing."""
    keys = G.listing(spark, root).select(G._rel_key(F.col("path"), root).alias("key"))
    return keys.where(~F.startswith("key", F.lit(G.QUARANTINE))).distinct().withColumn("landed", F.lit(True))


def summarize(verdicts: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct verdicts per table key (how many part files a table landed in
    depends on the cluster, so they are not counted). A landed file without a
    verdict gives its table a LOST row, one judged twice a REPEATED row."""
    v = verdicts.groupBy("key", "status", "reason").agg(F.count(F.lit(1)).alias("n"))
    v = v.join(files, "key", "full_outer")
    status = F.when(F.col("n").isNull(), "LOST").when(F.col("landed") & (F.col("n") > 1), "REPEATED")
    return v.select(F.split("key", "/").getItem(0).alias("table_key"),
                    F.coalesce(status, "status").alias("status"),
                    F.coalesce("reason", F.lit("landed without a verdict")).alias("reason")).distinct()


def _verdict_sql(missing: list[str]) -> str:
    """The verdicts the landing folder above must get: (key, what was done)."""
    rows = [("encounters.csv", "ACCEPTED", "15 columns, sample OK"),
            ("observations.csv", "REJECTED", "missing columns: [VALUE]"),
            ("patients.csv", "REJECTED", "missing columns: [Id]"),
            ("procedures.csv", "REJECTED", "header present but no data rows"),
            ("other.csv", "SKIPPED", "not a tracked file")]
    rows += [(k, "REJECTED", "empty file, no header") for k in missing]
    return "SELECT * FROM (VALUES " + ", ".join(map(str, rows)) + ") t(table_key, status, reason)"


@q("file_gate")
def file_gate(spark, sf):
    """Verdict per landed file, summarised per
    table key."""
    root = build_landing(spark, sf)
    return summarize(G.gate_batch(spark, root, expected=list(REQUIRED_COLUMNS)), landed_keys(spark, root))


SQL["file_gate"] = _verdict_sql(["conditions.csv", "medications.csv"])


@q("file_gate_stream")
def file_gate_stream(spark, sf):
    """The same gate as files arrive (Structured Streaming)."""
    root = build_landing(spark, sf)
    work = scratch_dir(spark, "gate-stream")
    G.gate_stream(spark, root, f"{work}/audit", f"{work}/_checkpoint")
    G.gate_stream(spark, root, f"{work}/audit", f"{work}/_checkpoint")  # nothing new
    return summarize(spark.read.parquet(f"{work}/audit"), landed_keys(spark, root))


SQL["file_gate_stream"] = _verdict_sql([])


@q("quarantine_sink")
def quarantine_sink(spark, sf):
    """K2: rejected files' lines land in the quarantine dataset with their
    reason; the summary counts lines per file and reason."""
    root = build_landing(spark, sf)
    res = G.gate_batch(spark, root, expected=list(REQUIRED_COLUMNS))
    dest = scratch_dir(spark, "quarantine")
    G.quarantine(spark, root, res, dest)
    qd = G.quarantined(spark, dest).withColumn("table_key", F.split("key", "/").getItem(0))
    # every part file has one header line
    return qd.groupBy("table_key", "reason").agg(
        (F.count(F.lit(1)) - F.count_distinct("key")).cast("bigint").alias("data_lines"))


SQL["quarantine_sink"] = (
    "SELECT 'observations.csv' AS table_key, 'missing columns: [VALUE]' AS reason, count(*) AS data_lines FROM ("
    + O.landed("observations") + ") o UNION ALL SELECT 'patients.csv', 'missing columns: [Id]', count(*) FROM ("
    + O.landed("patients") + ") p UNION ALL SELECT 'procedures.csv', 'header present but no data rows', 0"
)
