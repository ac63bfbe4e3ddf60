"""Point lookups by sweeping a key's timeline, instead of range joins.

``EXISTS (same key AND point.ts BETWEEN a AND b)`` and ``COUNT(earlier rows
of the same key)`` are written in the reference as joins on the key plus a
range condition, which pair every row of a key with every other row of it.
Here query rows and point rows of a key are put on one timeline (a UNION),
ordered by (ts, kind) with queries before points at the same instant, and
one skew-safe ordered scan gives each query

* ``next``: the earliest point at or after the query time (suffix MIN), and
* ``count_before``: the number of points strictly before it (prefix SUM; 0
  where there is none).

``EXISTS(point in [a, b])`` is then ``next(a) <= b``; a count in a window
``[t0, t)`` is ``count_before(t) - count_before(t0)``. Work is one sort of
(queries + points) per key-block; no pairs are formed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import Spec, asc, ordered_scan

QSET = "__qset"
KIND = "__kind"


def sweep(keys: list[str], id_cols: list[str], queries: dict[str, DataFrame],
          points: dict[str, DataFrame], ops: list[tuple[str, str, str]],
          ts_type: str | None = None, plain: bool | None = None) -> DataFrame:
    """queries[name]: keys + id_cols + ``ts``; points[name]: keys + ``ts``.

    ops: (output, point set, 'next' | 'count_before'). Returns one row per
    query row: keys, ``__qset``, id_cols and the outputs. ``plain``: the
    caller's proof (or disproof) that rows per key are within the limit.
    """
    first = next(iter(queries.values()))
    ts_type = ts_type or first.schema["ts"].dataType.simpleString()
    id_types = {c: first.schema[c].dataType.simpleString() for c in id_cols}
    pnames = list(points)

    def unify(df: DataFrame, kind: int, qset: str | None, pset: str | None) -> DataFrame:
        ts = F.col("ts").cast(ts_type).alias("ts")
        cols = [F.col(k) for k in keys] + [ts, F.lit(kind).alias(KIND),
                                            F.lit(qset).cast("string").alias(QSET)]
        cols += [(F.col(c) if pset is None else F.lit(None).cast(id_types[c])).alias(c)
                 for c in id_cols]
        cols += [(F.col("ts").cast(ts_type) if p == pset else F.lit(None).cast(ts_type))
                 .alias(f"__p_{p}") for p in pnames]
        return df.select(*cols)

    parts = [unify(q, 0, name, None) for name, q in queries.items()]
    # a point with a NULL key matches nothing (NULL = NULL is not true in the
    # joins this replaces); queries with a NULL key then find no point
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    parts += [unify(p.filter(has_key), 1, None, name) for name, p in points.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)

    specs = []
    for out, pset, how in ops:
        if how == "next":
            specs.append(Spec(out, "min", F.col(f"__p_{pset}"), "after"))
        elif how == "count_before":
            specs.append(Spec(out, "sum", F.when(F.col(f"__p_{pset}").isNotNull(), F.lit(1)),
                              "before"))
        else:
            raise ValueError(how)
    res = ordered_scan(u, keys, asc("ts", KIND), specs, plain=plain)
    return res.filter(F.col(KIND) == 0).select(*keys, QSET, *id_cols, "ts",
                                                *[F.coalesce(F.col(o), F.lit(0)).alias(o)
                                                  if how == "count_before" else o
                                                  for o, _, how in ops])


def pick(qset: str, value) -> F.Column:
    """Aggregate helper: the value from the query row of one query set."""
    v = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(F.col(QSET) == qset, v))
