"""Exact rounding and line arithmetic on decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status and payment names.
DELIVERED = "Delivered"
RETURNED = "Returned"
CANCELLED = "Cancelled"
PAID = "Paid"
COD = "COD"


HUNDREDTH = Decimal("0.01")
RATIO_UNITS = 1_000_000  # line discounts are averaged in millionths of a percent


def whole_cents(amount: Column) -> Column:
    """Two-decimal money as a whole number, for fast exact arithmetic on single lines."""
    return (amount * 100).cast("bigint")


def quotient(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded half up to two decimals, exactly.

    The division is done once on wide decimals, so neither floating point nor an intermediate
    rounding can move a value across a half, and sums over the largest groups do not overflow.  A
    zero denominator gives NULL.
    """
    safe = F.nullif(denominator.cast("decimal(30,0)"), F.lit(0))
    size = F.call_function("div", F.abs(numerator).cast("decimal(30,2)") * 200 + safe, safe * 2)
    hundredths = size * F.when(numerator < 0, -1).otherwise(1)
    return (hundredths.cast("decimal(19,0)") * HUNDREDTH).cast("decimal(19,2)")


def percentage(part: Column, whole: Column) -> Column:
    """Share of ``part`` in ``whole`` in percent, two decimals."""
    return quotient(part.cast("decimal(26,2)") * 100, whole)


def money(amount: Column) -> Column:
    """Two-decimal money for output."""
    return F.round(amount, 2)


def line_revenue() -> Column:
    """Revenue of one order line (exact: two decimals times a whole number)."""
    return F.col("unit_price") * F.col("quantity")


def line_profit() -> Column:
    """Margin of one order line."""
    return (F.col("unit_price") - F.col("unit_cost")) * F.col("quantity")


def line_discount_pct(list_price: str = "list_price") -> Column:
    """Discount of one line in percent, two decimals; NULL for a zero list price."""
    return percentage(whole_cents(F.col("discount_amount")), whole_cents(F.col(list_price)))


def mean_discount_pct(list_price: str = "list_price") -> Column:
    """Mean over lines of the discount in percent, two decimals.

    Each line's percentage is rounded to millionths and they are summed as whole numbers, so the
    result does not depend on the order of addition.
    """
    price = F.nullif(whole_cents(F.col(list_price)), F.lit(0))
    doubled = whole_cents(F.col("discount_amount")) * (200 * RATIO_UNITS)
    millionths = F.call_function("div", doubled + price, price * 2)
    lines = F.count(millionths).cast("decimal(20,0)")
    return quotient(F.sum(millionths.cast("decimal(20,0)")), lines * RATIO_UNITS)


def month_start(day: str = "order_date") -> Column:
    """First day of the calendar month; group by this and format the few groups afterwards."""
    return F.trunc(day, "MM")


def month_text(month: str) -> Column:
    """A month start as ``yyyy-MM``."""
    return F.date_format(month, "yyyy-MM")


def delivery_days() -> Column:
    """Days from order to delivery; NULL while undelivered."""
    return F.datediff("delivered_date", "order_date")
