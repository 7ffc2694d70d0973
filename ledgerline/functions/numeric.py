"""Small numeric and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """A ratio that is blank, not an error, where the denominator is zero."""
    return F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0)))


def signed_log1p(col: Column) -> Column:
    """``log1p`` for money that may be negative (refunds): the sign is kept."""
    value = col.cast("double")
    return F.signum(value) * F.log1p(F.abs(value))


def week_start(col: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", col))


def month_start(col: Column) -> Column:
    return F.to_date(F.date_trunc("month", col))


def clip(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to a range, leaving NULL alone (``least`` and ``greatest`` would skip it)."""
    out = col
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(col.isNotNull(), out)


def whole_days(later: Column, earlier: Column) -> Column:
    """Completed days between two timestamps."""
    return F.timestamp_diff("DAY", earlier, later).cast("int")


def hash_order(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random ordering key, the same in any engine with md5."""
    return F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))
