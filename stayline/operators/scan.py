"""Skew-safe ordered scans over a key (running MAX/MIN/SUM before or after
each row), the building block for every per-patient sequence computation.

A plain ``Window.partitionBy(patient)`` puts a patient's whole history into
one task; a patient holding a third of all rows would then be one task. Here
the scan is split in two levels:

1. rows are range-partitioned by (key, full order, row number) from a sample,
   and the partition a row falls into is its block. Blocks are contiguous in
   the order and of bounded size whatever crowds together: one patient, one
   minute, one instant, rows without a time or without a key. A window over
   (key, block) computes the *local* running value;
2. one summary row per (key, block) (a partial aggregate, so it is cheap to
   shuffle) is scanned over the blocks of the key to give each block its
   *carry* from the blocks before (or after) it, and is joined back on
   (key, block), which keeps the big side where it already is (same hash
   partitioning as the window). Blocks without a carry are dropped first.

The result equals the single-window result exactly because blocks are
contiguous in the ordering and MAX / MIN / SUM are associative.

Strategy, decided from a measured bound (like a broadcast behind a size
check, with the other way beyond it): rows are counted per key (one map-side
combined aggregate, one number to the driver). If the largest key has at most
``stayline.scan.maxRowsPerKey`` rows (default 1,000,000 - a sort one task
handles with bounded memory) a plain window over the key runs; otherwise the
rows are written once in blocks of about half that many rows. The block
numbers are part of the written table, so every later stage, retried or not,
sees the same blocks.

``stayline.scan.mode`` = auto | blocked | window overrides the choice.

Key columns are carried as non-NULL text (NULL becomes a sentinel no real
value uses), so NULL keys form one group as they do in a window and the
carry join stays a plain equi-join on the window's own partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize as _materialize

KEY = "__scan_k"     # prefix of the key columns: __scan_k0, __scan_k1, ...
BLK = "__scan_blk"
ROW = "__scan_row"   # number of the row in the written input, the last tie-break
_NULL_KEY = "\u0000<null>"

MODE_CONF = "stayline.scan.mode"
MAX_ROWS_CONF = "stayline.scan.maxRowsPerKey"
DEFAULT_MAX_ROWS_PER_KEY = 1_000_000
LEAST_BLOCKS = 8

# Every frame is a *prefix* frame (UNBOUNDED PRECEDING .. k), which Spark
# evaluates incrementally. A suffix ("after" / "from") is the prefix of the
# reversed order; a frame ending at UNBOUNDED FOLLOWING would instead be
# recomputed for every row, quadratic in the partition size.
_FRAMES = {
    "before": (False, -1),
    "upto": (False, 0),
    "after": (True, -1),
    "from": (True, 0),
}


@dataclass(frozen=True)
class Spec:
    """One scan output: ``func`` of ``value`` over rows ``frame`` the current
    row, in the key's ordering. frame: before | upto | after | from."""

    name: str
    func: str  # max | min | sum
    value: str | Column
    frame: str = "before"


def prepare(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add the key columns."""
    return df.select("*", *[F.coalesce(F.col(k).cast("string"), F.lit(_NULL_KEY)).alias(f"{KEY}{i}")
                            for i, k in enumerate(keys)])


def _keys(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(KEY)]


def _agg(func: str, c: Column) -> Column:
    return {"max": F.max, "min": F.min, "sum": F.sum}[func](c)


def _combine(func: str, local: Column, carry: Column) -> Column:
    if func == "max":
        return F.greatest(local, carry)
    if func == "min":
        return F.least(local, carry)
    # like SUM itself: NULL only where neither part holds a value
    return F.coalesce(local + carry, local, carry)


def _limit(spark) -> int:
    return int(spark.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS_PER_KEY)))


def bound_ok(spark, rows_per_key: int) -> bool:
    """True when a *known* upper bound of the rows per key is within the
    limit (or the mode forces the plain window)."""
    mode = spark.conf.get(MODE_CONF, "auto")
    if mode in ("blocked", "window"):
        return mode == "window"
    return rows_per_key <= _limit(spark)


def small_keys(d: DataFrame, keys: list[str]) -> bool:
    """True when no key holds more than the per-key row limit (one
    aggregation job, map-side combined; one number reaches the driver)."""
    spark = d.sparkSession
    mode = spark.conf.get(MODE_CONF, "auto")
    if mode in ("blocked", "window"):
        return mode == "window"
    biggest = d.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return (biggest or 0) <= _limit(spark)


def in_blocks(d: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``d`` (a written table) written again in ranges of (keys, order, row),
    with the range as block number. Ranges come from a sample; half the limit
    is aimed at, so that an uneven one stays below it."""
    parts = max(LEAST_BLOCKS, -(-2 * d.count() // _limit(d.sparkSession)))
    ranged = d.withColumn(ROW, F.monotonically_increasing_id()).repartitionByRange(
        parts, *[F.col(k).asc() for k in keys], *asc_nulls_last(*order), F.col(ROW).asc())
    return _materialize(ranged.withColumn(BLK, F.spark_partition_id().cast("bigint")))


def scan(df: DataFrame, order: list[str], specs: list[Spec],
         materialize: bool = True, plain: bool | None = None,
         by: list[str] | None = None) -> DataFrame:
    """Run ``specs`` over a frame prepared by :func:`prepare`.

    ``order``: column names giving the order within the key (ascending, NULLs
    last); rows equal in all of them may stand in any order.
    The input is read by two consumers (the size probe and the window); unless
    it is a cheap scan (``materialize=False``) it is written once to the
    checkpoint directory so that neither recomputes the upstream. Beyond the
    bound it is always written: once as it is, once in blocks. ``plain``: the caller already proved (True) or disproved
    (False) the per-key size bound. ``by``: the key columns themselves; the
    single window partitions by them, so a later grouping or join on them
    finds the rows already in place.
    """
    vals = {s.name: (F.col(s.value) if isinstance(s.value, str) else s.value) for s in specs}
    d = df.select("*", *[vals[s.name].alias(f"__v_{s.name}") for s in specs])
    keys = _keys(df)
    fwd = [F.col(c).asc_nulls_last() for c in order]
    bwd = [F.col(c).desc_nulls_first() for c in order]
    done = False
    if plain is None:
        if materialize:
            d, done = _materialize(d), True
        plain = small_keys(d, keys)
    if plain:
        return _window_scan(df, d, by or keys, fwd, bwd, specs)
    if not done:
        d = _materialize(d)
    out_cols = list(df.columns)
    if BLK not in d.columns:
        d = in_blocks(d, keys, order)
        out_cols += [ROW, BLK]
    fwd, bwd = fwd + [F.col(ROW).asc()], bwd + [F.col(ROW).desc()]
    return _blocked_scan(out_cols, d, keys, fwd, bwd, specs)


def _blocked_scan(out_cols: list[str], d: DataFrame, keys: list[str], fwd, bwd,
                  specs: list[Spec]) -> DataFrame:
    w = {False: Window.partitionBy(*keys, BLK).orderBy(*fwd),
         True: Window.partitionBy(*keys, BLK).orderBy(*bwd)}

    def local_col(s: Spec) -> Column:
        backward, hi = _FRAMES[s.frame]
        frame = w[backward].rowsBetween(Window.unboundedPreceding, hi)
        return _agg(s.func, F.col(f"__v_{s.name}")).over(frame).alias(f"__l_{s.name}")

    local = d.select("*", *[local_col(s) for s in specs])
    summary = local.groupBy(*keys, BLK).agg(
        *[_agg(s.func, F.col(f"__v_{s.name}")).alias(f"__b_{s.name}") for s in specs])
    ws = {False: Window.partitionBy(*keys).orderBy(F.col(BLK).asc()),
          True: Window.partitionBy(*keys).orderBy(F.col(BLK).desc())}
    carry_cols = []
    for s in specs:
        backward = _FRAMES[s.frame][0]
        frame = ws[backward].rowsBetween(Window.unboundedPreceding, -1)
        carry_cols.append(_agg(s.func, F.col(f"__b_{s.name}")).over(frame)
                          .alias(f"__c_{s.name}"))
    ck = [f"__c{k}" for k in keys]
    some = reduce(lambda a, b: a | b, [F.col(f"__c_{s.name}").isNotNull() for s in specs])
    carry = (summary.select(*[F.col(k).alias(c) for k, c in zip(keys, ck)],
                            F.col(BLK).alias("__cb"), *carry_cols)
             # only blocks that have a neighbour block carry anything: a key
             # inside one block (the common case) drops out here, so the
             # join's right side holds only keys spread over several blocks
             .filter(some)
             # same hash layout as the windowed side, so only this small
             # table moves for the join
             .repartition(*[F.col(c) for c in ck], F.col("__cb")))
    cond = reduce(lambda a, b: a & b, [local[k] == carry[c] for k, c in zip(keys, ck)])
    j = local.join(carry, cond & (local[BLK] == carry["__cb"]), "left")
    return j.select(
        *[F.col(c) for c in out_cols],
        *[_combine(s.func, F.col(f"__l_{s.name}"), F.col(f"__c_{s.name}")).alias(s.name)
          for s in specs],
    )


def _window_scan(df: DataFrame, d: DataFrame, keys: list[str], fwd, bwd,
                 specs: list[Spec]) -> DataFrame:
    """The single-window form (used when every key is small enough)."""
    w = {False: Window.partitionBy(*keys).orderBy(*fwd),
         True: Window.partitionBy(*keys).orderBy(*bwd)}
    cols = []
    for s in specs:
        backward, hi = _FRAMES[s.frame]
        frame = w[backward].rowsBetween(Window.unboundedPreceding, hi)
        cols.append(_agg(s.func, F.col(f"__v_{s.name}")).over(frame).alias(s.name))
    return d.select(*[F.col(c) for c in df.columns], *cols)


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], specs: list[Spec],
                 materialize: bool = True, plain: bool | None = None) -> DataFrame:
    """prepare + scan + drop helper columns."""
    return finish(scan(prepare(df, keys), order, specs, materialize and plain is not True, plain, by=keys))


def finish(df: DataFrame) -> DataFrame:
    return df.drop(*_keys(df), BLK, ROW)


def asc(*cols: str) -> list[str]:
    """An ordering for :func:`scan`: these columns ascending, NULLs last."""
    return list(cols)


def asc_nulls_last(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]
