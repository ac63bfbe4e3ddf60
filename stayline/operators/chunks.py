"""Ordered arrays of row objects, of any length in total, in bounded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_chunks(rows: DataFrame, keys: list[str], position: str, columns: list[str], size: int) -> DataFrame:
    """Arrays of structs of ``columns``, one per key and ``size`` positions
    (``position`` numbers a key's rows 1..n): keys, chunk (from 0), items in the
    order of position. Chunk after chunk a key's arrays are its whole history;
    none holds more than ``size`` rows, so no key is too long for a row or a
    task. NULL keys form one group."""
    if size < 1:
        raise ValueError("a chunk holds at least one row")
    chunk = F.expr(f"(`{position}` - 1) div {int(size)}").cast("bigint").alias("chunk")
    item = F.struct(F.col(position).alias("__at"), F.struct(*columns).alias("item"))
    g = rows.groupBy(*keys, chunk).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return g.select(*keys, "chunk", F.col("items.item").alias("items"))
