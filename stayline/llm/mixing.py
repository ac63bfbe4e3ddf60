"""Mixing sources to target weights by weighted fair queueing (native).

Every source is a flow. Its documents are put into a seeded shuffled order
and repeated up to ``max_repeats`` times; a copy's virtual finish time is its
source's running word count divided by the source's target. All copies are
ranked by finish time over a fixed grid of time ranges, and the mix is cut
where the running total reaches the budget (the size of all documents).

Scale: running sums are two-level. Words are summed per (source, order
range), those few sums are accumulated, and each range is then scanned by
itself, so a source holding a third of all rows is spread over as many ranges
as any. The global order is done the same way over ranges of finish time.

Defined results: a null text has size 0; a document of size 0 and documents
of a source of size 0 are never taken; a null source is a source of its own,
ranked last; rows with equal doc_id are separate documents whose order among
themselves follows their text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged, whole_row

WORD = "[^\\x20\\x09-\\x0D]+"
RANGE_ROWS = 20_000


def word_count(col):
    """Number of words (runs of bytes other than space and \\t..\\r)."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    One row per source. Water level: sources sorted by capacity per weight
    are filled one after the other; the rest shares by weight. Sums are
    integers, so the only rounding is the final division."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("w", w.cast("long"))
         .withColumn("cap", F.col("source_size") * max_repeats)
         .withColumn("total", F.sum("source_size").over(Window.partitionBy())))
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (s.withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("rest_w", F.sum("w").over(after))
         .withColumn("over", F.col("cap") * F.col("rest_w") < F.col("rest") * F.col("w")))
    # the first source that is not above its capacity fixes the level
    s = s.withColumn("pos", F.row_number().over(fill))
    level = F.min(F.when(~F.col("over"), F.struct("pos", "rest", "rest_w"))).over(Window.partitionBy())
    s = s.withColumn("level", level)
    return s.select(
        "source", "source_size",
        F.when(F.col("over") | F.col("level").isNull(), F.col("cap").cast("double"))
        .otherwise((F.col("level.rest") * F.col("w")).cast("double")
                   / F.col("level.rest_w").cast("double")).alias("target"))


def _running(df: DataFrame, keys: list[str], rng: str, order: list, value: str, out: str,
             strict: bool = False) -> DataFrame:
    """Running sum of ``value`` by ``order`` inside ``keys``, where ``rng`` is
    a range number that grows with ``order``."""
    part = df.groupBy(*keys, rng).agg(F.sum(value).alias("_part"))
    w = Window.partitionBy(*keys).orderBy(rng).rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col(rng).alias("_p_rng"),
                       F.coalesce(F.sum("_part").over(w), F.lit(0)).alias("_base"))
    cond = F.col(rng) == F.col("_p_rng")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_p_{k}"))
    inner = Window.partitionBy(*keys, rng).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (df.join(part, cond)
            .withColumn(out, F.col("_base") + F.sum(value).over(inner))
            .drop("_base", "_p_rng", *[f"_p_{k}" for k in keys]))


def _order_key(seed: int, doc_id, text):
    """Seeded shuffle key of a document: equal on every run and engine."""
    return F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))),
                    F.md5(F.coalesce(text, F.lit(""))))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3,
        seed: int = 5, range_rows: int = RANGE_ROWS, text: str = "text",
        source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target,
    copies (times the mix takes it) and taken (words)."""
    d = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        _order_key(seed, F.col(doc_id), F.col(text)).alias("ord"))
    d = staged(d, "mix-sizes")
    n = d.count()
    ranges = max(16, -(-n // range_rows))
    sizes = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = staged(source_targets(sizes, weights, max_repeats), "mix-targets")
    g = goal.select(F.col("source").alias("g_source"), "source_size", "target")
    d = (d.join(g, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
         .withColumn("rng", F.floor(F.conv(F.substring("ord", 1, 8), 16, 10).cast("double")
                                    / 4294967296.0 * ranges).cast("long")))
    d = _running(d, ["source"], "rng", [F.col("ord"), F.col("doc_id").asc_nulls_first()], "size", "cum")
    d = staged(d.drop("rng"), "mix-queue")
    # copies: epoch e of a document finishes at (e * source_size + cum) / target
    copies = (d.where((F.col("size") > 0) & (F.col("target") > 0))
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
              .withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("cum")).cast("double")
                          / F.col("target"))
              .withColumn("rng", F.floor(F.col("finish") * ranges).cast("long"))
              .select("ord", "doc_id", "source", "size", "epoch", "finish", "rng"))
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("epoch"), F.col("ord"),
             F.col("doc_id").asc_nulls_first()]
    budget = goal.agg(F.sum("source_size")).first()[0] or 0  # one number
    ranked = _running(copies, [], "rng", order, "size", "total")
    taken = (ranked.where(F.col("total") <= budget)
             .groupBy(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"),
                      F.col("ord").alias("t_ord"))
             .agg(F.count(F.lit(1)).alias("n_taken"), F.max("epoch").alias("_e")))
    # rows that agree in doc_id, source and text share one order key; their
    # copies are split evenly below
    same = Window.partitionBy("doc_id", "source", "ord").orderBy(F.lit(0))
    twins = (d.withColumn("twin", F.row_number().over(same))
             .withColumn("twins", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "source", "ord"))))
    out = twins.join(taken, F.col("doc_id").eqNullSafe(F.col("t_id"))
                     & F.col("source").eqNullSafe(F.col("t_source"))
                     & (F.col("ord") == F.col("t_ord")), "left")
    n_taken = F.coalesce(F.col("n_taken"), F.lit(0))
    share = (F.floor(n_taken / F.col("twins"))
             + F.when(F.col("twin") <= n_taken % F.col("twins"), 1).otherwise(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      share.alias("copies"), (share * F.col("size")).alias("taken"), "ord", "twin")


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: every taken copy as a row with the columns of ``docs``
    (a document taken twice appears twice)."""
    text, source = kw.get("text", "text"), kw.get("source", "source")
    key = _order_key(kw.get("seed", 5), F.col(kw.get("doc_id", "doc_id")), F.col(text))
    m = (mix(docs, **kw).groupBy("ord", "source")
         .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("twins"))
         .where("copies > 0").select("ord", F.col("source").alias("m_source"), "copies", "twins"))
    hit = staged(docs.select(whole_row(docs).alias("row"), key.alias("key"), F.col(source).alias("source"))
                 .join(m, (F.col("key") == F.col("ord")) & F.col("source").eqNullSafe(F.col("m_source"))),
                 "mix-taken")
    # equal rows (same doc_id, source and text) share their copies
    share = (F.floor(F.col("copies") / F.col("twins"))
             + F.when(F.col("twin") <= F.col("copies") % F.col("twins"), 1).otherwise(0))
    twin = Window.partitionBy("key", "source").orderBy(F.lit(0))
    parts = hit.where("twins = 1").withColumn("twin", F.lit(1)).unionByName(
        hit.where("twins > 1").withColumn("twin", F.row_number().over(twin)))
    return (parts.withColumn("n", share.cast("int")).where("n > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*"))
