"""Data-quality checks as DataFrame operators (Q1-Q3, Q14).

A check returns its violating rows (empty = pass); ``count_*`` helpers turn
a batch of checks into (check_name, violations) rows in as few passes as
possible: all not-null checks of a table are one aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_counts(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """One pass: NULL count per column -> (model, column_name, violations)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"n{i}")
                    for i, c in enumerate(columns)])
    parts = ", ".join(f"'{c}', n{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {parts}) AS (column_name, violations)") \
        .select(F.lit(model).alias("model"), "column_name", "violations")


def duplicated_keys(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` (non-NULL) that occur more than once."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).count()
            .filter(F.col("count") > 1))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a key that has no parent row (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    c = child.filter(F.col(key).isNotNull())
    return c.join(p, c[key] == p["__pk"], "left_anti")


def count_rows(name: str, df: DataFrame, **labels) -> DataFrame:
    cols = [F.lit(v).alias(k) for k, v in labels.items()]
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("check_name"), *cols, "violations")


def report(checks: list[DataFrame]) -> DataFrame:
    """Union of (check_name, violations) rows with a PASS / FAIL status."""
    u = reduce(DataFrame.unionByName, [c.select("check_name", "violations") for c in checks])
    return u.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
