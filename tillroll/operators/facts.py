"""The wide line-grain fact table, narrow extracts of it, and its derived columns."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import (
    delivery_days,
    line_discount_pct,
    line_profit,
    line_revenue,
    month_start,
)
from tillroll.operators.revenue import fact_orders
from tillroll.sources.files import ORDER_MONTH, in_months
from tillroll.sources.schemas import Star


def joined(star: Star) -> DataFrame:
    """All five tables at line grain.

    Orders meet customers and lines meet products before orders meet lines, so the lines are
    shuffled on the order only (and on the product, if the products are too large to broadcast);
    payments then join on the same partitioning.  Payments come last because the adaptive skew
    join splits a hot order only where both sides of a join come straight from an exchange: it
    can do so for orders and lines, and once it has, for payments too.  Filters and column
    choices made on the result are pushed below the joins.
    """
    headers = star.orders.drop("payment_method").join(star.customers, "customer_id")
    lines = star.order_items.withColumnRenamed("list_price", "item_list_price").join(
        star.products, "product_id"
    )
    return lines.join(headers, "order_id").join(star.payments, "order_id")


# The columns of the fact table by the table they come from; keys are listed once.
FACT_SOURCES = {
    "orders": (
        "order_id",
        "order_date",
        "order_status",
        "channel",
        "ship_carrier",
        "delivered_date",
    ),
    "customers": (
        "customer_id",
        "full_name",
        "city",
        "state",
        "age",
        "segment",
        "signup_date",
    ),
    "products": (
        "product_id",
        "product_name",
        "category",
        "sub_category",
        "brand",
        "unit_cost",
    ),
    "order_items": (
        "line_no",
        "quantity",
        "item_list_price",
        "discount_amount",
        "unit_price",
    ),
    "payments": (
        "grand_total",
        "tax_amount",
        "shipping_fee",
        "payment_status",
        "payment_method",
    ),
}
FACT_COLUMNS = tuple(column for columns in FACT_SOURCES.values() for column in columns)
JOIN_KEYS = {
    "orders": ("order_id", "customer_id"),
    "customers": ("customer_id",),
    "products": ("product_id",),
    "order_items": ("order_id", "product_id"),
    "payments": ("order_id",),
}


def fact_table(star: Star) -> DataFrame:
    """One row per order line with its order, customer, product and payment."""
    return joined(star).select(*FACT_COLUMNS)


def derived(facts: DataFrame) -> DataFrame:
    """Add revenue, profit, discount_pct, delivery_days and order_month to fact rows."""
    return facts.withColumns(
        {
            "revenue": F.round(line_revenue(), 2),
            "profit": F.round(line_profit(), 2),
            "discount_pct": line_discount_pct("item_list_price"),
            "delivery_days": delivery_days(),
            "order_month": month_start(),
        }
    )


def fact_null_summary(star: Star) -> DataFrame:
    """Columns of the fact table, derived ones included, that contain NULLs.

    Gives what :func:`quality.null_summary` gives on the derived fact table, but each table is
    first reduced to its keys and one whole number with a bit per NULL, so that the joins move
    five numbers per line instead of all its columns.
    """
    missing = {
        table: {c: F.col(c.removeprefix("item_")).isNull() for c in columns}
        for table, columns in FACT_SOURCES.items()
    }
    missing["orders"]["delivery_days"] = delivery_days().isNull()
    missing["orders"]["order_month"] = month_start().isNull()
    missing["order_items"]["revenue"] = line_revenue().isNull()
    missing["order_items"]["discount_pct"] = line_discount_pct().isNull()

    def bits(conditions: Iterable[Column]) -> Column:
        marks = [F.when(c, 1 << place).otherwise(0) for place, c in enumerate(conditions)]
        return reduce(Column.bitwiseOR, marks)

    reduced = {
        table: getattr(star, table).select(
            *JOIN_KEYS[table], bits(conditions.values()).alias(f"{table}_nulls")
        )
        for table, conditions in missing.items()
    }

    def is_set(table: str, column: str) -> Column:
        place = list(missing[table]).index(column)
        return F.col(f"{table}_nulls").bitwiseAND(1 << place) != 0

    found = {c: is_set(table, c) for table, conditions in missing.items() for c in conditions}
    found["profit"] = found["revenue"] | found["unit_cost"]
    return (
        joined(Star(**reduced))
        .agg(*[F.count_if(condition).alias(c) for c, condition in found.items()])
        .unpivot([], list(found), "column_name", "null_count")
        .filter(F.col("null_count") > 0)
    )


# The columns of the sample.
SAMPLE_COLUMNS = (
    "order_id",
    "order_date",
    "order_status",
    "customer_id",
    "city",
    "segment",
    "category",
    "quantity",
    "unit_price",
    "grand_total",
)


def _of_orders(star: Star, ids: DataFrame) -> Star:
    """The star narrowed to some orders: their headers, lines and payments, and their buyers.

    ``ids`` holds order_id, each once.  Where it is small Spark broadcasts it, and lines and
    payments of other orders are dropped ahead of any shuffle.
    """
    kept = {
        table: getattr(star, table).join(ids, "order_id", "left_semi")
        for table in ("orders", "order_items", "payments")
    }
    buyers = kept["orders"].select("customer_id").distinct()
    return Star(
        customers=star.customers.join(buyers, "customer_id", "left_semi"),
        products=star.products,
        **kept,
    )


def fact_sample(star: Star, rows: int = 1000, ordered: bool = True) -> DataFrame:
    """A narrow extract of ``rows`` lines.

    Ordered, it is the same sample each time: as every order of the fact table has a line, the
    lines of its ``rows`` lowest order ids are enough to sort.  Unordered, Spark may stop as soon
    as it has enough.
    """
    if not ordered:
        return joined(star).select(*SAMPLE_COLUMNS).limit(rows)
    present = fact_orders(
        star.orders.select("order_id", "customer_id"),
        star.payments,
        star.order_items,
        star.products,
        star.customers,
    )
    lowest = present.select("order_id").distinct().orderBy("order_id").limit(rows)
    rest = [c for c in SAMPLE_COLUMNS if c != "order_id"]
    return (
        joined(_of_orders(star, lowest))
        .select(*SAMPLE_COLUMNS)
        .orderBy("order_id", *rest)
        .limit(rows)
    )


def chosen_orders(
    orders: DataFrame,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    channel: str | None = None,
) -> DataFrame:
    """Orders of a date range (both ends included) and a sales channel; orders stored by month are
    pruned to the months of the range."""
    by_month = ORDER_MONTH in orders.columns
    if start is not None:
        orders = orders.filter(F.col("order_date") >= F.lit(start))
        if by_month:
            orders = orders.filter(F.col(ORDER_MONTH) >= F.lit(start.replace(day=1)))
    if end is not None:
        orders = orders.filter(F.col("order_date") <= F.lit(end))
        if by_month:
            orders = orders.filter(F.col(ORDER_MONTH) <= F.lit(end.replace(day=1)))
    if channel is not None:
        orders = orders.filter(F.col("channel") == channel)
    return orders


def in_range(
    star: Star,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    channel: str | None = None,
) -> Star:
    """The star as any report over a date range (both ends included) and a sales channel needs it:
    only the orders chosen, and lines and payments pruned to the months of the range where they are
    stored by month.  Reports join them to the orders, which leaves out what is left over."""
    return replace(
        star,
        orders=chosen_orders(star.orders, start, end, channel),
        order_items=in_months(star.order_items, start, end),
        payments=in_months(star.payments, start, end),
    )


def fact_query(
    star: Star,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    channel: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Fact rows of a date range (both ends included), sales channel and product category.

    Every parameter is optional.  Orders are chosen first, by filters that reach their scan; lines
    and payments are then narrowed to the chosen orders, and products to the category.
    """
    narrowed = in_range(star, start, end, channel)
    if category is not None:
        narrowed = replace(narrowed, products=star.products.filter(F.col("category") == category))
    orders = narrowed.orders
    if (start, end, channel) != (None, None, None):
        narrowed = _of_orders(narrowed, orders.select("order_id").distinct())
    return fact_table(narrowed)
