"""Exact money arithmetic.

Prices, rates and revenues are multiplied and summed as DECIMAL, rounded half
up, and turned into DOUBLE only for display.  Rounding a DOUBLE product or sum
gives answers that depend on the order of the additions and on how the engine
rounds binary fractions; the decimal form gives one answer everywhere.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions._col import as_col


def money(c: str | Column) -> Column:
    """A stored money amount as ``MONEY_TYPE``; NULL beyond its range."""
    return as_col(c).try_cast(K.MONEY_TYPE)


def _units(c: str | Column, scale: int) -> Column:
    """The amount counted in units of 10^-scale, a whole decimal.

    Whole decimals multiply without losing digits to a reduced scale.
    """
    kept = as_col(c).try_cast(f"decimal({12 + scale},{scale})")
    return (kept * F.lit(Decimal(10) ** scale)).try_cast(f"decimal({12 + scale},0)")


def _product(factors: list[Column], scale: int) -> Column:
    """The product of whole decimals that count 10^-scale, as money: rounded half
    up once, NULL if a factor is NULL or the product has over 38 digits."""
    exact = factors[0]
    for f in factors[1:]:
        exact = F.try_multiply(exact, f)
    rounded = F.round(exact, K.MONEY_SCALE - scale)
    return money(rounded * F.lit(Decimal(1).scaleb(-scale)))


def line_revenue(price: str | Column, quantity: str | Column,
                 rate: str | Column) -> Column:
    """``round(price * quantity * rate, 4)`` computed exactly.

    NULL when any factor is NULL (e.g. no FX rate known for the order date)
    or out of range.
    """
    return _product([_units(price, K.PRICE_SCALE), as_col(quantity).try_cast("decimal(10,0)"),
                     _units(rate, K.RATE_SCALE)], K.PRICE_SCALE + K.RATE_SCALE)


def price_at_rate(price: str | Column, rate: str | Column) -> Column:
    """``round(price * rate, 4)`` exactly; NULL like ``line_revenue``."""
    return _product([_units(price, K.PRICE_SCALE), _units(rate, K.RATE_SCALE)],
                    K.PRICE_SCALE + K.RATE_SCALE)


def round_money(c: str | Column, scale: int = 2) -> Column:
    """Round a decimal amount half up to ``scale`` places."""
    return F.round(as_col(c), scale)


def money_avg(c: str | Column, scale: int = 2) -> Column:
    """Average of the non-null amounts, rounded half up to ``scale`` places.

    Exact: decimal sum divided by the count keeps 14 fractional digits, far
    more than a half-unit tie at ``scale`` needs to be decided correctly.
    """
    total = F.sum(money(c))
    n = F.count(as_col(c))
    return F.round(total / F.when(n > 0, n), scale)
