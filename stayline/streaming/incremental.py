"""Exactly-once incremental load.

A file already loaded contributes nothing on a re-run: the Structured
Streaming file source records consumed files in its checkpoint, and
``trigger(availableNow=True)`` processes whatever is new, then stops. A
deliberate reload uses a fresh checkpoint and overwrites the target.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load_new_files(spark: SparkSession, src: str, schema: StructType, target: str,
                   checkpoint: str, fmt: str = "parquet") -> int:
    """Append the rows of files not loaded yet, through Spark's Parquet file
    sink (exactly-once: a replayed micro-batch is not committed twice).
    Returns the number of micro-batches that ran."""
    before = _last_batch(spark, checkpoint)
    q = (spark.readStream.format(fmt).schema(schema).load(src)
         .writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _last_batch(spark, checkpoint) - before


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last committed micro-batch (-1: none); the checkpoint has
    them all, progress reports only the latest."""
    try:
        done = spark.read.text(f"{checkpoint}/commits").select("_metadata.file_name").distinct()
        return done.agg(F.max(F.col("file_name").try_cast("long"))).first()[0]
    except AnalysisException:
        return -1


def reload_all(spark: SparkSession, src: str, schema: StructType, target: str,
               checkpoint: str, fmt: str = "parquet") -> int:
    """Deliberate full reload (truncate + force): the target is emptied
    (overwritten, its file-sink log included) and every file in ``src`` is
    loaded again through the same exactly-once sink under a new source log
    (``checkpoint`` must be a folder not used before), so later incremental
    loads with that checkpoint continue from here. Returns the row count."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(target)
    load_new_files(spark, src, schema, target, checkpoint, fmt)
    return spark.read.parquet(target).count()
