"""Exact money arithmetic in integer cents.

Sums of doubles depend on evaluation order and ROUND differs between engines at
ties, so amounts are carried as BIGINT cents and every rounded average or
percentage is an integer half-up division. Intermediates are DECIMAL(38,0) so a
product such as ``cents * 10000 * 2`` cannot overflow at any realistic scale.
All helpers assume non-negative numerators and positive divisors (clean data);
a zero or NULL divisor gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_cents(amount) -> Column:
    """Double amount → BIGINT cents (nearest cent; NULL and bad values → NULL)."""
    return F.round(_c(amount) * 100).try_cast("bigint")


def cents_to_amount(cents) -> Column:
    """BIGINT cents → DOUBLE amount at the output edge."""
    return _c(cents).cast("double") / 100


def half_up_div(num, den, scale: int = 1) -> Column:
    """round(num · scale / den) half-up in integers, (2·num·scale + den) div
    (2·den) → BIGINT; NULL when den <= 0.

    BIGINT arithmetic with overflow checks (`try_*` gives NULL on overflow)
    covers every realistic amount; only an overflowing row takes the
    DECIMAL(38,0) path (`coalesce` evaluates it lazily)."""
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    top = F.try_add(F.try_multiply(n, F.lit(2 * scale)), d)
    fast = F.call_function("div", top, F.try_multiply(d, F.lit(2)))
    nw, dw = n.cast(_WIDE), d.cast(_WIDE)
    wide = F.call_function("div", nw * (2 * scale) + dw, dw * 2)
    return F.when(d > 0, F.coalesce(fast, wide))


def avg_amount(sum_cents, count) -> Column:
    """ROUND(AVG(amount), 2) from a sum of cents and a row count → DOUBLE."""
    return half_up_div(sum_cents, count).cast("double") / 100


def ratio_amount(sum_cents, den) -> Column:
    """ROUND(SUM(amount) / den, 2) → DOUBLE (e.g. revenue per customer)."""
    return half_up_div(sum_cents, den).cast("double") / 100


def pct_2dp(num, den) -> Column:
    """ROUND(num * 100.0 / den, 2) → DOUBLE, exact for integer num/den (counts or cents)."""
    return half_up_div(num, den, 10000).cast("double") / 100


def pct_0dp(num, den) -> Column:
    """ROUND(num * 100 / den) → DOUBLE whole percent."""
    return half_up_div(num, den, 100).cast("double")


