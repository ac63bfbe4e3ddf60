"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_null(*parts) -> Column:
    """The ``||`` operator: NULL if any part is NULL; numbers become text."""
    return F.concat(*[_c(p).cast("string") for p in parts])


def null_if(x, value) -> Column:
    return F.nullif(_c(x), F.lit(value))


def iff(cond: Column, a, b) -> Column:
    """IFF(c, a, b): a NULL condition takes the ELSE branch."""
    return F.when(cond, a).otherwise(b)


def first_group_ci(s, pattern: str) -> Column:
    """First capture group of a case-insensitive regex; NULL when no match."""
    v = F.regexp_extract(_c(s), "(?i)" + pattern, 1)
    return F.when(F.regexp_like(_c(s), F.lit("(?i)" + pattern)), v)


def split_csv_line(line) -> Column:
    """Split one CSV line into fields: commas inside double quotes do not
    split, surrounding quotes are removed and doubled quotes collapse."""
    raw = F.split(_c(line), r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(
        raw,
        lambda f: F.regexp_replace(F.regexp_replace(f, r'^"|"$', ""), '""', '"'),
    )


def has_prefix(s, prefix: str) -> Column:
    return F.startswith(_c(s), F.lit(prefix))
