"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text date layouts, tried in order. The loader reads day-first
# (style 103, dd/mm/yyyy, one- or two-digit day and month); ISO is the fallback.
DATE_FORMATS = ("d/M/yyyy", "yyyy-MM-dd")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col, formats=DATE_FORMATS) -> Column:
    """TRY_CONVERT(DATE, text): first layout that parses wins; NULL when none does."""
    c = F.trim(_c(col))
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def stay_days(start, end) -> Column:
    """Calendar days between two dates (DATE_DIFF(end, start, DAY) / DATEDIFF(DAY, start, end))."""
    return F.datediff(_c(end), _c(start))


def days_before(as_of, n) -> Column:
    """DATEADD(DAY, -n, as_of) with an explicit as-of date instead of GETDATE()."""
    return F.date_sub(_c(as_of) if not isinstance(as_of, str) else F.lit(as_of).cast("date"), _c(n) if not isinstance(n, int) else F.lit(n))


def between_dates(col, lo: str, hi: str) -> Column:
    """Inclusive date range on a DATE column (never on a timestamp, trap T5)."""
    return _c(col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
