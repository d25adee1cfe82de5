"""Exact money arithmetic on built-in decimal expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.schemas import HUGE_PRICE, LARGE_PRICE, PERCENT, PRICE

_AMOUNT = "decimal(30,2)"


def line_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """Price of a line after discount, rounded half up to cents; NULL if any input is NULL.

    Every step is exact before the one rounding, for prices below 1e14 with 8 decimals and, beyond
    those, below 1e18 with 3, which is all that a double has there. Larger prices have a
    ``huge_amount`` instead.
    """
    paid = _paid(quantity, discount_pct)
    usual = _in_halves(paid, unit_price.try_cast(PRICE), 8, 11)
    return F.coalesce(usual, _in_halves(paid, unit_price.try_cast(LARGE_PRICE), 3, 13)).cast(_AMOUNT)


def huge_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """The amount of a line, as a double, where its price is too large for ``line_amount``; else NULL."""
    huge = (unit_price >= HUGE_PRICE) & (unit_price < float("inf"))
    share = (F.lit(100.0) - discount_pct) / F.lit(100.0)
    # the share first: a price next to the largest double must not overflow before its discount
    return F.when(huge, unit_price * share * quantity)


def _paid(quantity: Column, discount_pct: Column) -> Column:
    """Quantity times the paid share of 100 %, in units of 1e-8: 10 and 11 digits."""
    units = F.lit(Decimal(100_000_000))
    share = ((F.lit(Decimal(100)) - discount_pct.try_cast(PERCENT)) * units).cast("decimal(11,0)")
    return (quantity.cast("decimal(10,0)") * share).cast("decimal(21,0)")


def _in_halves(paid: Column, price: Column, decimals: int, digits: int) -> Column:
    """Whole cents of ``paid * price`` as a decimal.

    The product may have more digits than a decimal holds, so the price, in units of its last decimal
    place, is multiplied in two halves of ``digits`` digits, whose sum is rounded with its carry.
    """
    price = (price * F.lit(Decimal(10**decimals))).cast("decimal(22,0)")
    half = F.lit(Decimal(10**digits))
    low = price % half
    high = _quotient(price, half).cast("decimal(11,0)")
    # the product counts 10 ** -(decimals + 10); a cent is 10 ** (decimals + 8) of that
    cent = decimals + 8
    below = (paid * low.cast(f"decimal({digits},0)")).cast("decimal(35,0)") + F.lit(Decimal(5 * 10 ** (cent - 1)))
    if digits >= cent:
        whole = (paid * high).cast("decimal(32,0)") * F.lit(Decimal(10 ** (digits - cent)))
        cents = whole.cast("decimal(36,0)") + _quotient(below, F.lit(Decimal(10**cent)))
    else:
        whole = (paid * high).cast("decimal(36,0)") + _quotient(below, half)
        cents = _quotient(whole.cast("decimal(36,0)"), F.lit(Decimal(10 ** (cent - digits))))
    return cents.cast("decimal(30,0)") * F.lit(Decimal("0.01"))


def _quotient(x: Column, y: Column) -> Column:
    """Whole part of ``x / y`` for whole decimals, neither negative. ``div`` would end at 64 bits."""
    return ((x - x % y) / y).cast("decimal(38,0)")


def as_money(total: Column, huge: Column | None = None) -> Column:
    """A sum of cents-exact decimals at the output edge, and with it that of huge amounts."""
    exact = total.cast("double")
    return exact if huge is None else F.coalesce(exact + huge, exact, huge)


def mean_money(total: Column, n: Column, huge: Column | None = None) -> Column:
    """``total / n`` rounded half up to cents, NULL for ``n = 0``; ``total`` must not be negative.

    With ``huge`` amounts among them the mean is a plain quotient: cents are far below its precision.

    Works on whole cents. A decimal quotient would be cut to few places before it is rounded, which
    turns some means just below half a cent the wrong way once a group has over 10,000 rows.
    """
    twice = F.lit(Decimal(2))
    cents = (total * F.lit(Decimal(100))).cast("decimal(37,0)")
    rows = F.nullif(n, F.lit(0)).cast("decimal(19,0)")
    rounded = _quotient((cents * twice + rows).cast("decimal(38,0)"), (rows * twice).cast("decimal(20,0)"))
    exact = as_money(rounded.cast("decimal(36,0)") * F.lit(Decimal("0.01")))
    return exact if huge is None else F.when(huge.isNull(), exact).otherwise(as_money(total, huge) / n)
