"""Small helpers shared by the registered queries (Spark side and oracle
SQL side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .models import Models

_CACHE: dict = {}


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models.from_driver(spark, sf_dir)


def cnt_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def cnt() -> Column:
    return F.count(F.lit(1)).cast("bigint")


def avg1(x: Column) -> Column:
    """ROUND(AVG(x), 1) for integer x, rounded half away from zero in exact
    integer tenths, so both engines agree digit for digit."""
    s = F.sum(x.cast("bigint"))
    c = F.count(x)
    mag = F.floor(F.try_divide(F.abs(s) * F.lit(20) + c, c * F.lit(2)))
    return F.when(c > 0, F.signum(s) * mag.cast("double") / F.lit(10.0))


def side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two single-row aggregates with disjoint columns as one row, without a
    join: each is padded with NULLs for the other's columns, the two rows are
    unioned and a global MAX (which skips NULLs) folds them into one."""
    ca, cb = a.columns, b.columns
    ua = a.select(*ca, *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in cb])
    ub = b.select(*[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in ca], *cb)
    return ua.unionByName(ub).agg(*[F.max(c).alias(c) for c in ca + cb])


def check_row(name: str, violations: DataFrame) -> DataFrame:
    """(check_name, violations) for a frame of violating rows."""
    return violations.agg(cnt().alias("violations")).select(
        F.lit(name).alias("check_name"), "violations")


# --- oracle SQL fragments ----------------------------------------------------

def sql_cif(cond: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT)"


def sql_pct(part: str, whole: str) -> str:
    p, w = f"CAST({part} AS BIGINT)", f"CAST({whole} AS BIGINT)"
    return (f"CASE WHEN {w} <> 0 THEN CAST(floor((1000 * {p} + floor({w} / 2)) / {w}) AS DOUBLE) / 10 "
            f"END")


def sql_avg1(x: str) -> str:
    s, c = f"SUM(CAST({x} AS BIGINT))", f"COUNT({x})"
    return (f"CASE WHEN {c} > 0 THEN sign({s}) * CAST(floor((abs({s}) * 20 + {c}) / ({c} * 2)) "
            f"AS DOUBLE) / 10 END")


def sql_check(name: str, violating_select: str) -> str:
    return (f"SELECT '{name}' AS check_name, CAST(COUNT(*) AS BIGINT) AS violations "
            f"FROM ({violating_select}) AS v")
