"""Display strings of the dashboard, built from exact integers.

Rounding is done on integer cents / hundredths with half-up division first, so
the text does not depend on how a double happens to be represented.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import half_up_div


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_space_to_newline(s) -> Column:
    """Replace the first space by a line break (chart label on two lines)."""
    return F.regexp_replace(_c(s), r"^([^ ]*) ", "$1\n")


def thousands(n) -> Column:
    """Whole number with thousands separators: 12345 → '12,345'."""
    return F.format_number(_c(n).cast("bigint"), 0)


def currency_0dp(cents) -> Column:
    """'$' + whole currency units with separators, rounded half-up: 123456 → '$1,235'."""
    return F.concat(F.lit("$"), F.format_number(half_up_div(cents, F.lit(100)), 0))


def thousands_label(cents) -> Column:
    """Axis label in thousands: 1,234,567 cents → '$12K'."""
    return F.concat(F.lit("$"), half_up_div(cents, F.lit(100000)).cast("string"), F.lit("K"))


def percent_1dp(hundredths) -> Column:
    """A percentage held in hundredths (1234 = 12.34 %) → '12.3%'."""
    tenths = half_up_div(hundredths, F.lit(10))
    return F.concat((tenths.cast("decimal(20,0)") / 10).cast("decimal(20,1)").cast("string"),
                    F.lit("%"))


def padded_id(prefix: str, n, width: int = 6) -> Column:
    """prefix + the number zero-padded to `width` digits, never truncated
    (printf '%0{width}d' for non-negative numbers, without a formatter per row)."""
    t = _c(n).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(t) >= width, t)
                    .otherwise(F.lpad(t, width, "0")))
