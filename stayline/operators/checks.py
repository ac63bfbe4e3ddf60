"""Fused data-quality checks (Q1-Q3, Q5, Q11, Q14): checks are declared, and
all that read one table run in one pass over it.

``tally`` counts any number of row predicates of a table in one global
aggregate. ``key_pass`` answers every uniqueness and every referential check in
one grouping: each table sends its keys once, as (domain, key, slot), where a
slot is a (table, column) and the slots that a relationship links share a
domain. The counts per slot of one key tell whether it is repeated and whether
it has a parent. The grouping combines before the shuffle, so a key that holds
a third of the rows arrives as one row per input partition.

Both return one row per check: its labels, and ``violations``. An empty table
gives zeros. NULL keys are never repeated and need no parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stacked(wide: DataFrame, labels: list[dict]) -> DataFrame:
    """The one row of ``wide`` (columns c0, c1, ...) as a row per column."""
    return wide.select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in of.items()], F.col(f"c{i}").alias("violations"))
        for i, of in enumerate(labels)])))


def tally(df: DataFrame, checks: list[tuple[dict, Column]]) -> DataFrame:
    """Rows of ``df`` each predicate holds for; unknown is no violation."""
    return _stacked(df.agg(*[F.count_if(p).cast("bigint").alias(f"c{i}") for i, (_, p) in enumerate(checks)]),
                    [labels for labels, _ in checks])


def domains(slots: list[tuple[str, str]], related) -> dict[tuple[str, str], int]:
    """Slots linked by a relationship, directly or through others, have one
    number."""
    of = {s: i for i, s in enumerate(slots)}
    for _, t, c, pt, pc in related:
        a, b = of[t, c], of[pt, pc]
        of = {s: min(a, b) if d in (a, b) else d for s, d in of.items()}
    return of


def key_pass(frames: dict[str, DataFrame], unique: list[tuple] = (), related: list[tuple] = ()) -> DataFrame:
    """``unique``: (labels, table, column), violated by every value that occurs
    more than once; ``related``: (labels, table, column, parent table, parent
    column), violated by every row whose key no parent row has. Keys are
    compared as strings: the two sides of a relationship have one type."""
    slots = sorted({(t, c) for _, t, c in unique} | {(t, c) for _, t, c, *_ in related}
                   | {tuple(r[3:]) for r in related})
    domain = domains(slots, related)

    def keys(table: str) -> DataFrame:
        sent = [F.struct(F.lit(domain[s]).alias("domain"), F.col(s[1]).cast("string").alias("key"),
                         F.lit(i).alias("slot")) for i, s in enumerate(slots) if s[0] == table]
        return frames[table].select(F.inline(F.array(*sent))).where(F.col("key").isNotNull())

    sent = reduce(DataFrame.unionByName, [keys(t) for t in dict.fromkeys(t for t, _ in slots)])
    n = {s: F.col(f"n{i}") for i, s in enumerate(slots)}
    held = sent.groupBy("domain", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(len(slots))])
    totals = [F.count_if(n[t, c] > 1) for _, t, c in unique]
    totals += [F.coalesce(F.sum(F.when(n[pt, pc] == 0, n[t, c])), F.lit(0)) for _, t, c, pt, pc in related]
    return _stacked(held.agg(*[x.cast("bigint").alias(f"c{i}") for i, x in enumerate(totals)]),
                    [check[0] for check in [*unique, *related]])
