"""Interval operators: gaps-and-islands merging and point-in-time counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_diff
from .scan import KEY, Spec, asc, finish, prepare, scan, small_keys

OPEN_END = "9999-12-31"


def number_islands(df: DataFrame, key: str, start: str, end: str, tiebreak: str,
                   plain: bool | None = None) -> DataFrame:
    """Gaps-and-islands over timestamp intervals of each key.

    Rows are ordered by (start, end, tiebreak). ``prev_max_end`` is the
    running MAX of *earlier* ends (a short stay nested in a long one cannot
    break the chain; NULL ends are ignored, as MAX ignores them). A row opens
    a new island when there is no earlier end or the earlier end falls on an
    earlier calendar day than its start. ``island_number`` is the running sum
    of those flags; ``seq`` the row's position within the key.
    """
    order = asc(start, end, tiebreak)
    p = prepare(df, [key])
    # both scans see the same rows per key: one size probe decides for both;
    # with small keys the two windows share one exchange and nothing is
    # materialised in between
    if plain is None:
        plain = small_keys(p, [c for c in p.columns if c.startswith(KEY)])
    s1 = scan(p, order, [Spec("prev_max_end", "max", end, "before")], materialize=False,
              plain=plain, by=[key])
    s1 = s1.withColumn(
        "new_island",
        F.when(F.col("prev_max_end").isNull() | (day_diff("prev_max_end", start) > 0), F.lit(1))
        .otherwise(F.lit(0)))
    s2 = scan(s1, order, [Spec("island_number", "sum", "new_island", "upto"),
                          Spec("seq", "sum", F.lit(1), "upto")], materialize=not plain,
              plain=plain, by=[key])
    return finish(s2)


def island_events(df: DataFrame, keys: list[str], start: str, stop: str,
                  plain: bool | None = None) -> DataFrame:
    """Sweep events of each key's merged [start, stop] day intervals (stop
    NULL = still open): +1 on the first day of every island of overlapping
    intervals and -1 on the day after it ends. Intervals ending before they
    start cover no day and are dropped.

    One ordered scan and one pass over its rows suffice: a row opens an island
    when its start is after the running MAX of earlier ends, and that running
    MAX, seen by the row opening island k+1, is exactly the end of island k
    (ends of earlier islands are all smaller). The last row of a key, which has
    no row after it, closes the last island. Returns keys[0], day, delta.
    """
    open_end = F.to_date(F.lit(OPEN_END))
    d = (df.filter(F.col(start).isNotNull()
                   & (F.col(stop).isNull() | (F.col(stop) >= F.col(start))))
         .select(*keys, F.col(start).alias("s"), F.coalesce(F.col(stop), open_end).alias("e")))
    s1 = finish(scan(prepare(d, keys), asc("s", "e"),
                     [Spec("prev_e", "max", "e", "before"), Spec("more", "sum", F.lit(1), "after")],
                     materialize=plain is not True, plain=plain, by=keys))
    opens = F.col("prev_e").isNull() | (F.col("s") > F.col("prev_e"))
    reach = F.greatest("prev_e", "e")

    def event(when, day, delta):
        return F.when(when, F.struct(day.alias("day"), F.lit(delta).alias("delta")))

    events = F.array(event(opens, F.col("s"), 1),
                     event(opens & F.col("prev_e").isNotNull(), F.date_add("prev_e", 1), -1),
                     event(F.col("more").isNull() & (reach != open_end), F.date_add(reach, 1), -1))
    return s1.select(keys[0], F.explode(F.array_compact(events)).alias("x")).select(keys[0], "x.day", "x.delta")


def count_covering(events: DataFrame, key: str, queries: DataFrame, q_day: Column,
                   id_cols: list[str], out: str) -> DataFrame:
    """For each query row (key, id_cols, day) the running sum of the key's
    events (key, day, delta) up to and including that day: with island
    events this is the number of islands covering the day.

    Events are swept with the queries in day order, events before queries on
    the same day. A query with a NULL day gets 0.
    """
    id_types = {c: queries.schema[c].dataType.simpleString() for c in id_cols}
    ev = events.select(F.col(key), "day", F.lit(0).alias("__k"), "delta",
                       *[F.lit(None).cast(t).alias(c) for c, t in id_types.items()])
    q = queries.select(F.col(key), q_day.alias("day"), F.lit(1).alias("__k"),
                       F.lit(0).alias("delta"), *[F.col(c) for c in id_cols])
    u = ev.unionByName(q)
    p = prepare(u, [key])
    s = finish(scan(p, asc("day", "__k"), [Spec("__run", "sum", "delta", "upto")]))
    return s.filter(F.col("__k") == 1).select(
        F.col(key), *id_cols,
        F.when(F.col("day").isNull(), F.lit(0)).otherwise(F.col("__run")).cast("bigint").alias(out))
