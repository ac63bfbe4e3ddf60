"""Tables laid out by a key, so that windows, groupings and joins on the key
find its rows in place.

:func:`placed` hashes rows by the key once; :func:`bucketed` writes them as a
bucketed, sorted table under the shared folder and reads it back with the same
partitioning. Frames placed or bucketed by one key in the same number of parts
share a layout: unions keep it, and windows, groupings by the key (and more)
and joins on it need no further exchange.

A key's rows are then one task's. Callers use a layout only where a count
showed that no key exceeds the row limit (``operators.scan``), and range
blocks elsewhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS_CONF = "spark.sql.sources.bucketing.maxBuckets"


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets for a layout of ``rows`` narrow rows, all that meet in one stage
    counted: enough that one holds about ROWS_PER_BUCKET, not fewer than the
    session's tasks at a time (or its shuffle partitions, if fewer)."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    most = int(spark.conf.get(MAX_BUCKETS_CONF, "100000"))
    return max(1, least, min(most, -(-rows // ROWS_PER_BUCKET)))


def placed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows hashed by ``key`` into ``buckets`` parts."""
    return df.repartition(buckets, key)


def bucketed(df: DataFrame, key: str, buckets: int, sort: list[str] | None = None) -> DataFrame:
    """``df`` written in buckets of ``key`` (sorted within them by ``sort``, for
    readers that skip by those columns) and read back.

    ``df`` should be placed already (:func:`placed`, or a window or grouping on
    top of it), else every task writes a piece of every bucket. The table lies
    under the session's checkpoint folder; its catalog entry is needed only to
    read the layout and is dropped at once (the files of an external table
    stay), so runs leave nothing in a shared metastore."""
    spark = df.sparkSession
    name = f"layout_{uuid.uuid4().hex[:16]}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    w = df.write.format("parquet").option("path", path).bucketBy(buckets, key)
    (w.sortBy(*sort) if sort else w).saveAsTable(name)
    # new names for the columns: a union keeps a layout only of unqualified ones
    table = spark.table(name).select(*[F.col(c).alias(c) for c in df.columns])
    spark.sql(f"DROP TABLE {name}")
    return table
