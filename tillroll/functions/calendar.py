"""Calendar-derived columns: names, weekend flag, season, demand factor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# English weekday names (Sunday first, as dayofweek numbers them)
# and month names, as the reference's date_format patterns EEEE / MMMM render them.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


def _lookup(names: list[str], idx: Column) -> Column:
    # explicit NULL guard: element_at with a NULL index is not NULL in generated code
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in names]), idx))


def day_name(d) -> Column:
    """English weekday name (a lookup by weekday number, no date formatter)."""
    return _lookup(DAY_NAMES, F.dayofweek(_c(d)))


def month_name(d) -> Column:
    return _lookup(MONTH_NAMES, F.month(_c(d)))


def is_weekend(d) -> Column:
    """Saturday or Sunday; a NULL date gives False (not NULL)."""
    return F.coalesce(F.dayofweek(_c(d)).isin(1, 7), F.lit(False))


def day_type(weekend_flag) -> Column:
    """'Weekend' only when the flag is TRUE; FALSE and NULL give 'Weekday'."""
    return F.when(_c(weekend_flag) == F.lit(True), "Weekend").otherwise("Weekday")


# Southern-hemisphere seasons by month number.
SEASONS = [
    ("Summer", (12, 1, 2)),
    ("Autumn", (3, 4, 5)),
    ("Winter", (6, 7, 8)),
    ("Spring", (9, 10, 11)),
]


def australian_season(d) -> Column:
    """Season of the month; NULL date → NULL (no otherwise branch)."""
    m = F.month(_c(d))
    expr = None
    for name, months in SEASONS:
        expr = (F.when(m.isin(*months), name) if expr is None
                else expr.when(m.isin(*months), name))
    return expr


def revenue_category(amount, low_below: float, medium_below: float) -> Column:
    """Band of a line amount: < low → Low, < medium → Medium, else (and NULL) High."""
    c = _c(amount)
    return (F.when(c < F.lit(low_below), "Low")
            .when(c < F.lit(medium_below), "Medium")
            .otherwise("High"))


# Demand multipliers, kept as integer tenths so the adjustment is exact.
# Saturday x1.4, Sunday x1.3, 15-31 December x1.8, April x1.2 (they multiply).
SATURDAY_TENTHS, SUNDAY_TENTHS = 14, 13
LATE_DECEMBER_TENTHS, APRIL_TENTHS = 18, 12


def demand_factor_thousandths(d) -> Column:
    """Multiplier x 1000 as an integer: weekday part x December part x April part."""
    d = _c(d)
    dow = F.dayofweek(d)
    wk = (F.when(dow == 7, SATURDAY_TENTHS).when(dow == 1, SUNDAY_TENTHS)
          .otherwise(10))
    dec = F.when((F.month(d) == 12) & (F.dayofmonth(d) >= 15),
                 LATE_DECEMBER_TENTHS).otherwise(10)
    apr = F.when(F.month(d) == 4, APRIL_TENTHS).otherwise(10)
    return (wk * dec * apr).cast("bigint")
