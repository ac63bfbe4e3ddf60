"""Column profile of a dataset (S5, V37): one row per column with ordinal,
name, type, rows, NULLs, distinct values, min and max (as text).

Counts and extremes come from one aggregation (a wide row unpivoted with
``stack``); distinct values from a narrow unpivot de-duplicated map-side. Floating-point extremes are
rendered with six decimals so the text does not depend on the engine's
shortest-repr algorithm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

PROFILE_COLUMNS = ["ordinal", "column_name", "data_type", "rows", "nulls", "distinct_values",
                   "min_value", "max_value"]


def _text(df: DataFrame, name: str, agg):
    c = F.col(f"`{name}`")
    v = agg(c)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.format_string("%.6f", v)
    return v.cast("string")


def column_profile(df: DataFrame) -> DataFrame:
    """Two passes, both narrow: (1) one aggregate for rows, NULLs, min, max of
    every column; (2) distinct counts from an unpivot of (column, value-text)
    pairs, de-duplicated map-side before the shuffle. (Many ``count_distinct``
    in one aggregate would instead copy every wide row once per column.)"""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).cast("bigint").alias("__rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [
            F.count_if(c.isNull()).cast("bigint").alias(f"n{i}"),
            _text(df, f.name, F.min).alias(f"lo{i}"),
            _text(df, f.name, F.max).alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    parts = []
    for i, f in enumerate(fields):
        name = f.name.replace("'", "''")
        parts.append(f"{i + 1}, '{name}', '{f.dataType.simpleString()}', n{i}, lo{i}, hi{i}")
    expr = (f"stack({len(fields)}, {', '.join(parts)}) "
            "AS (ordinal, column_name, data_type, nulls, min_value, max_value)")
    stats = wide.selectExpr("__rows AS rows", expr)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.col(f"`{f.name}`").cast("string").alias("v"))
        for i, f in enumerate(fields)])).alias("p")).select("p.ordinal", "p.v")
    distinct = (pairs.filter(F.col("v").isNotNull()).distinct().groupBy("ordinal")
                .agg(F.count(F.lit(1)).cast("bigint").alias("distinct_values")))
    out = stats.join(distinct, "ordinal", "left")
    return out.select(F.col("ordinal").cast("int").alias("ordinal"), "column_name", "data_type",
                      "rows", "nulls",
                      F.coalesce("distinct_values", F.lit(0)).cast("bigint").alias("distinct_values"),
                      "min_value", "max_value")


def ordered_template(profile: DataFrame, group: str) -> DataFrame:
    """The profile rows of each group as one ordered array of
    structs (ordinal, name, type, nullable), rendered as text. A group is one
    table, so the array is bounded by its number of columns."""
    rows = profile.select(
        group, F.struct("ordinal", "column_name", "data_type",
                        (F.col("nulls") > 0).alias("has_nulls")).alias("col"))
    arr = rows.groupBy(group).agg(F.sort_array(F.collect_list("col")).alias("cols"))
    return arr.select(
        group,
        F.size("cols").cast("bigint").alias("n_columns"),
        F.array_join(F.transform("cols", lambda x: F.concat_ws(
            ":", x["ordinal"].cast("string"), x["column_name"], x["data_type"],
            x["has_nulls"].cast("string"))), ",").alias("template"))
