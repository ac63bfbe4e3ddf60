"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def stage_path(spark, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (its own only when unset)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and go on from the
    files: the lineage ends there, so a lost executor rereads them."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_row(df: DataFrame):
    """All columns of ``df`` as one struct, so that columns added beside it
    cannot clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
