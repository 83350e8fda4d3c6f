"""Exact decimal money.

Amounts are computed in exact decimals and rounded once, at the mart
boundary, half away from zero (as a NUMERIC column rounds on insert).
Percent discounts enter as ``(100 - d)`` factors, so a line discounted
twice is an exact multiple of 10^-10; numerators are summed first and the
``10^-4`` scale is applied afterwards as a product, never as a division.

Every helper returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QTY = "decimal(10,0)"
PRICE = "decimal(12,2)"
PCT = "decimal(5,2)"
# A sum of qty*price*(100-d1)*(100-d2): money × 10^4 at scale 6, 22 integer digits.
NUMERATOR = "decimal(28,6)"
_BASIS_POINTS = "decimal(5,4)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_if_null(c, dtype: str) -> Column:
    return F.coalesce(_c(c), F.lit(0).cast(dtype))


def pct_factor(discount) -> Column:
    """``100 - d`` for a percent discount ``d`` (exact, scale 2)."""
    return F.lit(100).cast("decimal(3,0)") - _c(discount).cast(PCT)


def gross_line(qty, price) -> Column:
    """``qty * price`` — no discounts, cancelled units included (scale 2)."""
    return _c(qty).cast(QTY) * _c(price).cast(PRICE)


def net_quantity(qty, canceled) -> Column:
    """Units kept: ``max(qty - canceled, 0)``."""
    return F.greatest(_c(qty) - _c(canceled), F.lit(0))


def discounted_numerator(qty, price, *discounts) -> Column:
    """``qty * price * Π(100 - d)``: the discounted amount × 100^len(discounts)."""
    out = _c(qty).cast(QTY) * _c(price).cast(PRICE)
    for d in discounts:
        out = out * pct_factor(d)
    return out


def numerator_to_amount(numerator) -> Column:
    """Money from a two-discount numerator (money × 10^4): exact, scale 10."""
    return _c(numerator).cast(NUMERATOR) * F.lit("0.0001").cast(_BASIS_POINTS)


def to_money(amount, dtype: str = "decimal(18,2)") -> Column:
    """Round an exact amount half away from zero into a mart money column."""
    return _c(amount).cast(dtype)


def round_ratio(num, num_scale: int, den, out_scale: int, den_digits: int = 10) -> Column:
    """``num / NULLIF(den, 0)`` rounded half away from zero to ``out_scale``, exactly.

    ``num`` is exact with at most ``num_scale`` decimals, ``den`` a count below
    10^den_digits.  Spark keeps ``s1 + p2 + 1`` decimals in a decimal quotient
    when the result fits 38 digits; with ``num`` cast to
    ``decimal(38 - den_digits - 1, num_scale)`` it always fits, and the kept
    digits exceed the distance from any non-exact quotient to the nearest
    rounding boundary, so the one ``round`` below decides like exact
    arithmetic.  NULL when ``den`` is NULL or 0.
    """
    p1 = 38 - den_digits - 1
    n = _c(num).cast("decimal(%d,%d)" % (p1, num_scale))
    d = F.nullif(_c(den), F.lit(0)).cast("decimal(%d,0)" % den_digits)
    return F.round(n / d, out_scale).cast("decimal(18,%d)" % out_scale)
