"""Session helpers: defaults that the models rely on, and shared folders."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on (UTC like the reference's typing job) plus
# the runtime re-planning we want at scale. Everything else is left to the
# cluster's own configuration.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "stayline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_for_input(spark: SparkSession, input_bytes: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Size shuffles and scan splits from the measured input volume: enough
    initial shuffle partitions that each holds about ``target_partition_bytes``
    (AQE then coalesces small ones and splits skewed ones), and scan splits of
    the same size. Returns the settings applied."""
    parts = max(200, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint directory of the session.

    It is the shared location the cluster names in ``spark.checkpoint.dir``.
    Only when that is unset (local tests) do we register a fresh temporary
    folder of our own.
    """
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if conf:
            spark.sparkContext.setCheckpointDir(conf)
        elif re.match(r"local(\[|$)", spark.sparkContext.master):
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stayline-ckpt-"))
        else:
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared, reliable "
                               "folder (HDFS / object store) for checkpoints")
        base = spark.sparkContext.getCheckpointDir()
    return base


def materialize(df):
    """Write ``df`` once as Parquet under the shared folder and continue from
    the files: cuts the lineage (a lost executor rereads them instead of
    recomputing the upstream) and lets several consumers share one
    computation, each reading only its columns. Never a local checkpoint."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder under the cluster's checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, sub)
    return path


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A new, unique folder under the shared directory (one per run)."""
    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")
