"""The whole flow as one job: landed CSV -> file gate -> typing job for the
accepted tables -> models -> layer tables -> data-quality report.

    python -m stayline.pipeline --landing <dir> --out <dir> [--master local[8]]

Each stage reads what the previous one wrote, so a failed run can be
restarted from the last written layer, and lineage never spans stages.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import q_checks
from .plans.layers import materialize_layers
from .plans.models import Models
from .session import tune_for_input
from .sources import ingest as I
from .sources.schemas import REQUIRED_COLUMNS
from .streaming import gate as G

TABLES = ["patients", "encounters", "conditions", "medications", "procedures", "observations"]


def run_pipeline(spark: SparkSession, landing: str, out: str,
                 expected: int | None = None) -> dict:
    """Returns the gate verdicts, the layer paths, the tables without an
    accepted file and the quality report. ``expected``: the number of
    eligible episodes the report holds the model against."""
    out = out.rstrip("/")
    landed_bytes = G.listing(spark, landing).agg(F.sum("length")).first()[0] or 0
    tune_for_input(spark, int(landed_bytes))
    # every run adds its verdicts to the audit, under its own run id
    run = uuid.uuid4().hex
    (G.gate_batch(spark, landing, expected=list(REQUIRED_COLUMNS)).withColumn("run", F.lit(run))
     .write.mode("append").partitionBy("run").parquet(f"{out}/audit/gate"))
    verdicts = spark.read.parquet(f"{out}/audit/gate").where(F.col("run") == run)
    G.quarantine(spark, landing, verdicts, f"{out}/quarantine", remove=True)
    tracked = verdicts.withColumn("t", F.split("key", "/").getItem(0)).where(
        F.col("t").isin([f"{t}.csv" for t in TABLES]))
    # one row per tracked table
    counts = {r["t"]: (r["ok"], r["bad"]) for r in tracked.groupBy("t").agg(
        F.count_if(F.col("status") == "ACCEPTED").alias("ok"),
        F.count_if(F.col("status") == "REJECTED").alias("bad")).collect()}
    base, ingested = landing.rstrip("/"), []
    for t in TABLES:
        ok, bad = counts.get(f"{t}.csv", (0, 0))
        if not ok:
            continue
        src = f"{base}/{t}.csv"
        if bad:  # only the accepted files; Spark's file index holds their names anyway
            src = [G._glob_literal(f"{base}/{r['key']}") for r in
                   G.accepted_paths(tracked.where(F.col("t") == f"{t}.csv")).toLocalIterator()]
        I.ingest(spark, t, src, f"{out}/curated/{t}")
        ingested.append(t)
    missing = [t for t in ["patients", "encounters", "conditions", "procedures"]
               if t not in ingested]
    if missing:
        raise RuntimeError(f"cannot build the models without: {', '.join(missing)}")
    m = Models.from_paths(spark, f"{out}/curated")
    paths = materialize_layers(m, f"{out}/warehouse")
    # the checks read the tables just written, not a recomputation
    written = Models.from_paths(spark, f"{out}/curated").use_tables(paths)
    q_checks.full_report(written, expected).write.mode("overwrite").parquet(f"{out}/audit/dq_report")
    return {"gate": verdicts, "layers": paths, "not_ingested": [t for t in TABLES if t not in ingested],
            "dq_report": spark.read.parquet(f"{out}/audit/dq_report")}


def main() -> None:
    from .session import build_session

    ap = argparse.ArgumentParser(prog="python -m stayline.pipeline", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--landing", required=True, help="folder of landed <table>.csv files")
    ap.add_argument("--out", required=True, help="output root (audit, curated, warehouse)")
    ap.add_argument("--master", default=None, help="Spark master (default: the cluster's)")
    ap.add_argument("--expected-episodes", type=int, default=None,
                    help="number of eligible episodes the report checks for")
    a = ap.parse_args()
    spark = build_session(a.master)
    res = run_pipeline(spark, a.landing, a.out, a.expected_episodes)
    res["gate"].show(truncate=False)
    res["dq_report"].filter(F.col("status") != "PASS").show(truncate=False)


if __name__ == "__main__":
    main()
