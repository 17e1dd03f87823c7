"""Delivery time, returns and cancellations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import (
    CANCELLED,
    COD,
    DELIVERED,
    RETURNED,
    delivery_days,
    percentage,
    quotient,
)
from tillroll.operators.products import sold_lines
from tillroll.operators.revenue import fact_orders


def delivery_time(orders: DataFrame) -> DataFrame:
    """Delivered orders and their mean, shortest and longest delivery per carrier."""
    days = delivery_days()
    return (
        orders.filter((F.col("order_status") == DELIVERED) & F.col("delivered_date").isNotNull())
        .groupBy("ship_carrier")
        .agg(
            F.count("*").alias("delivered_orders"),
            quotient(F.sum(days), F.count(days)).alias("avg_delivery_days"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
        )
        .orderBy("avg_delivery_days", "ship_carrier")
    )


def status_rate(
    orders: DataFrame,
    by: Column,
    status: str,
    total_as: str,
    hits_as: str,
    rate_as: str,
    among: Sequence[str] | None = None,
) -> DataFrame:
    """Share of orders in ``status`` per group, among the given statuses or all orders."""
    if among is not None:
        orders = orders.filter(F.col("order_status").isin(*among))
    hit = F.count_if(F.col("order_status") == status)
    return (
        orders.groupBy(by)
        .agg(F.count("*").alias(total_as), hit.alias(hits_as))
        .withColumn(rate_as, percentage(F.col(hits_as), F.col(total_as)))
    )


def return_rate_by_carrier(orders: DataFrame) -> DataFrame:
    """Returned orders among delivered and returned ones, per carrier."""
    return status_rate(
        orders,
        F.col("ship_carrier"),
        RETURNED,
        "total_orders",
        "returned_orders",
        "return_rate_pct",
        among=(DELIVERED, RETURNED),
    ).orderBy(F.desc("return_rate_pct"), "ship_carrier")


def return_rate_carrier_chart(
    orders: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Returned orders among all orders of the fact table, cancelled ones included, per carrier."""
    present = fact_orders(orders, payments, order_items, products, customers)
    rates = status_rate(
        present, F.col("ship_carrier"), RETURNED, "total", "returned", "return_rate_%"
    )
    return rates.orderBy(F.desc("return_rate_%"), "ship_carrier")


def _category_returns(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, hits: Column
) -> DataFrame:
    """Per category: distinct orders and ``hits``, a sum over (order, category) rows.

    Each such row carries ``lines`` and ``returned_lines``.
    """
    returned = F.col("order_status") == RETURNED
    per_order = (
        sold_lines(
            orders,
            order_items.select("order_id", "product_id"),
            "order_status",
            statuses=(DELIVERED, RETURNED),
        )
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("order_id", "category")
        .agg(F.count_if(returned).alias("returned_lines"))
    )
    return (
        per_order.groupBy("category")
        .agg(F.count("order_id").alias("total_orders"), hits.alias("returned_orders"))
        .withColumn("return_rate_pct", percentage(F.col("returned_orders"), F.col("total_orders")))
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def return_rate_by_category(
    orders: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """Returned lines over distinct orders per category.

    The two grains differ, so a category bought on several lines of an order reads too high; see
    :func:`return_rate_by_category_orders` for orders over orders.
    """
    return _category_returns(orders, order_items, products, F.sum("returned_lines"))


def return_rate_by_category_orders(
    orders: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """Distinct returned orders over distinct orders per category."""
    return _category_returns(
        orders, order_items, products, F.count_if(F.col("returned_lines") > 0)
    )


def cancellation_by_payment(orders: DataFrame) -> DataFrame:
    """Cancelled orders among all orders per payment method."""
    return status_rate(
        orders,
        F.col("payment_method"),
        CANCELLED,
        "total_orders",
        "cancelled_orders",
        "cancellation_rate_pct",
    ).orderBy(F.desc("cancellation_rate_pct"), "payment_method")


def cancellation_cod_prepaid(orders: DataFrame, cod: str = COD) -> DataFrame:
    """Cancelled orders among all orders, cash on delivery against everything else."""
    kind = F.when(F.col("payment_method") == cod, F.lit(COD)).otherwise(F.lit("Prepaid"))
    return status_rate(
        orders,
        kind.alias("payment_kind"),
        CANCELLED,
        "total_orders",
        "cancelled_orders",
        "cancellation_rate_pct",
    ).orderBy("payment_kind")
