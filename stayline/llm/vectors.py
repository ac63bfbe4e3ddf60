"""Vector tables: which rows take part, and exact copies folded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def usable(v):
    """Not null, not empty, every component finite and not null, not all 0."""
    bad = F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def fold_copies(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding"):
    """(classes: cid, dim, v, copies, min_id; rows: vec_id, cid) of the usable
    rows; a class is one distinct vector, so a group of copies of any size is
    one class row."""
    good = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).where(usable(F.col("v")))
    classes = staged(good.groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("min_id"))
                     .select(F.monotonically_increasing_id().alias("cid"), F.size("v").alias("dim"), "v",
                             "copies", "min_id"), "vector-classes")
    rows = staged(good.join(classes.select("v", "cid"), "v").select("vec_id", "cid"), "vector-rows")
    return classes, rows
