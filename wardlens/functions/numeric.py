"""Safe conversion, safe division and exact half-up rounding.

Money stays ``decimal(18,2)``. Rounded averages and shares are computed from exact integer
sums and rounded once, half away from zero, by integer division; the result is emitted as a
double. This gives the same digits on every engine, where ``round(double)`` does not.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the numeric text accepted by a strict SQL conversion (optional sign, digits,
# optional fraction, surrounding ASCII blanks). Spark's try_cast alone also accepts '12d', 'NaN',
# '1e5'. Blanks are spelled out: ``\s`` means different characters in Java, RE2 and Python.
BLANKS = "[ \t\n\r\f]"
NUMERIC_TEXT = rf"^{BLANKS}*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+){BLANKS}*$"

MONEY = "decimal(18,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_numeric_text(col) -> Column:
    return _c(col).rlike(NUMERIC_TEXT)


def strip_blanks(col) -> Column:
    return F.regexp_replace(_c(col), rf"^{BLANKS}+|{BLANKS}+$", "")


def safe_number(col, dtype: str = MONEY) -> Column:
    """TRY_CAST semantics: NULL when the text is not a plain number or does not fit ``dtype``."""
    c = _c(col)
    return F.when(is_numeric_text(c), strip_blanks(c).try_cast(dtype))


def strict_number(col, dtype: str = MONEY, message: str | None = None) -> Column:
    """CAST semantics: a single bad value fails the whole job, whatever the ANSI setting."""
    c = _c(col)
    msg = message or f"Error converting data type to {dtype}."
    converted = strip_blanks(c).try_cast(dtype)
    return (F.when(c.isNull(), F.lit(None).cast(dtype))
             .when(converted.isNull() | ~is_numeric_text(c),
                   F.raise_error(F.concat(F.lit(msg + " Value: "), c)).cast(dtype))
             .otherwise(converted))


def safe_ratio(num, den) -> Column:
    """NULLIF(den, 0) / SAFE_DIVIDE: NULL on a zero or NULL denominator, never an error."""
    return F.try_divide(_c(num), _c(den))


def strict_ratio(num, den) -> Column:
    """Plain division: under ANSI a zero denominator raises DIVIDE_BY_ZERO."""
    return _c(num) / _c(den)


def _idiv(a: Column, b: Column) -> Column:
    """Integer quotient of non-negative decimals, as decimal(38,0): the division is exact, since the
    remainder is taken off first."""
    return ((a - a % b) / b).cast("decimal(38,0)")


def half_up_units(num, den, scale: int = 0) -> Column:
    """round(num / den, scale) half away from zero, as an exact count of 10^-scale units, decimal(38,0).

    ``num`` and ``den`` must be integer-valued; they are widened to decimal(38,0) so sums over
    billions of rows cannot overflow. NULL when ``den`` is 0 or NULL.
    """
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    size = F.nullif(F.abs(d), F.lit(0).cast("decimal(38,0)"))
    q = _idiv(F.abs(n) * F.lit(2 * 10 ** scale) + size, size * F.lit(2))
    return F.when((n < 0) != (d < 0), -q).otherwise(q)


def exact_round(num, den, scale: int) -> Column:
    """round(num / den, scale) half away from zero, exact, returned as double."""
    return (half_up_units(num, den, scale).cast("double") / F.lit(float(10 ** scale)))


def money_per_day(col, days) -> Column:
    """ROUND(money / days, 2) of one row, half away from zero, exact, as a double; NULL for 0 or NULL days.

    Whole cents by whole days need no more than 64 bits: money is decimal(18,2), so twice its cents is below
    2 * 10^18, and days are an int."""
    n, d = cents_long(col), F.nullif(_c(days).cast("bigint"), F.lit(0).cast("bigint"))
    q = F.call_function("div", F.abs(n) * F.lit(2) + F.abs(d), F.abs(d) * F.lit(2))
    return F.when((n < 0) != (d < 0), -q).otherwise(q).cast("double") / F.lit(100.0)


def exact_trunc(num, den) -> Column:
    """Integer average truncated toward zero (T-SQL AVG of an INT column)."""
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    q = _idiv(F.abs(n), F.nullif(F.abs(d), zero))
    return F.when((n < 0) != (d < 0), -q).otherwise(q).cast("bigint")


def cents_long(col) -> Column:
    """decimal(18,2) money as an exact bigint number of cents (|cents| < 10^18 always fits)."""
    return (_c(col).cast(MONEY) * F.lit(100)).cast("bigint")


def cents(col) -> Column:
    """Cents widened to decimal(38,0), for sums over any number of rows."""
    return cents_long(col).cast("decimal(38,0)")


def money_avg_rounded(col, scale: int = 2) -> Column:
    """ROUND(AVG(money), scale), exact: an aggregate expression."""
    return exact_round(F.sum(cents(col)), F.count(_c(col)) * F.lit(100), scale)


def money_avg(col) -> Column:
    """Unrounded AVG(money) as a double: exact cent sum / (count * 100)."""
    s = F.sum(cents(col))
    n = F.count(_c(col))
    return F.when(n > 0, s.cast("double") / (n * F.lit(100)).cast("double"))


# Decimals to which an average of ratios is given where it is not rounded to cents.
RATIO_SCALE = 12
# Units of the sum of the remainders of ratios: 10^-28, so a remainder of a 32-bit denominator fits 38 digits.
_PART = Decimal(10 ** 28)


def ratio_avg(sum_cents, den, count, scale: int) -> Column:
    """ROUND(AVG(money / den), scale), half away from zero: an aggregate over rows that hold, per distinct denominator,
    its sum of cents and its number of ratios (a zero or NULL denominator, or NULL sum, drops out, as SAFE_DIVIDE).

    Twice the sum of ratios in units of the last decimal is, per denominator, a whole quotient and a remainder over the
    denominator. The quotients add up as integers; of the remainders' sum only the whole part, and whether anything is
    left, can change the rounding, and both are read from integers in units of 10^-28. Nothing is rounded per row or per
    denominator. The number of rows does not matter; the result is exact if the least common multiple of the
    denominators times their number is below 10^28, which holds for all lengths of stay up to 60 days, and beyond
    unless a sum of fractions comes as near as that to a whole number without being one."""
    whole = "decimal(38,0)"
    zero, one = F.lit(0).cast(whole), F.lit(1).cast(whole)
    d = F.nullif(_c(den).cast("bigint"), F.lit(0).cast("bigint")).cast(whole)
    size = F.abs(d)
    n = F.when(d < 0, -_c(sum_cents).cast(whole)).otherwise(_c(sum_cents).cast(whole)) * F.lit(2 * 10 ** scale)
    over = F.abs(n) % size
    down = (n < 0) & (over > 0)  # floor, not towards zero
    quotient = F.when(n < 0, -_idiv(F.abs(n), size)).otherwise(_idiv(F.abs(n), size)) - F.when(down, one).otherwise(zero)
    rest = F.when(down, size - over).otherwise(over).cast("decimal(10,0)") * F.lit(_PART)
    used = d.isNotNull() & _c(sum_cents).isNotNull()
    quotients, parts = F.sum(F.when(used, quotient)), F.sum(F.when(used, _idiv(rest.cast(whole), size)))
    inexact = F.count_if(used & (rest.cast(whole) % size > 0)).cast(whole)
    unit = F.lit(_PART).cast(whole)
    ceiling = _idiv(parts, unit) + one
    reached = (inexact > 0) & (parts + inexact >= ceiling * unit)  # the remainders make up the next whole number
    low = quotients + F.when(reached, ceiling).otherwise(_idiv(parts, unit))
    more = F.when(~reached & ((inexact > 0) | (parts % unit > 0)), one).otherwise(zero)
    total = F.sum(F.when(used, _c(count))).cast(whole) * F.lit(100)
    twice = F.nullif(total * F.lit(2), zero)
    up = _idiv(low + total, twice)
    units = F.when(low >= 0, up).otherwise(-_idiv(-(low + more) + total, twice))
    return units.cast("double") / F.lit(float(10 ** scale))


def pct_decimal(part, whole) -> Column:
    """ROUND(part * 100 / whole, 2), exact, as decimal(5,2)."""
    return (half_up_units(_c(part) * F.lit(100), _c(whole), 2).cast("decimal(7,0)") / F.lit(100)).cast("decimal(5,2)")


def pct(part, whole, scale: int = 2) -> Column:
    """ROUND(part * 100 / whole, scale), exact; NULL when whole is 0."""
    return exact_round(_c(part) * F.lit(100), _c(whole), scale)
