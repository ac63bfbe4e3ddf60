"""Column helpers (JVM-side expressions only, no UDFs)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import (age_years, day_diff, day_number, hour_diff, midnight_days_before,  # noqa: F401
                    minute_diff, month_day, plus_days_keep_time, year_diff)
from .strings import (concat_null, first_group_ci, has_prefix, iff, null_if,  # noqa: F401
                      split_csv_line)


def pct(part, whole) -> Column:
    """ROUND(100 * part / whole, 1) for counts, rounded half up in exact
    integer tenths (so no binary-fraction tie can flip the last digit);
    NULL when ``whole`` is 0."""
    p = (F.col(part) if isinstance(part, str) else part).cast("bigint")
    w = (F.col(whole) if isinstance(whole, str) else whole).cast("bigint")
    tenths = F.floor(F.try_divide(p * F.lit(1000) + F.floor(w / F.lit(2)), w))
    return F.when(w != 0, tenths.cast("double") / F.lit(10.0))


def count_if(cond: Column) -> Column:
    """COUNT_IF as a bigint; NULL conditions are not counted."""
    return F.count_if(cond).cast("bigint")
