"""Order status distribution and revenue over time.

One revenue definition serves all reports: order totals of the chosen order and payment
statuses.  Orders and payments are joined one to one on the order, so the distinct order count
that follows runs on the join's own partitioning and costs no further exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import (
    DELIVERED,
    PAID,
    RETURNED,
    money,
    month_start,
    month_text,
    percentage,
)

REALISED = (DELIVERED,)  # order statuses that count as realised revenue
BILLED = (DELIVERED, RETURNED)  # order statuses that were billed, returned or not
SETTLED = (PAID,)  # payment statuses that count as received


def order_totals(
    orders: DataFrame,
    payments: DataFrame,
    *attributes: str,
    statuses: Sequence[str] = REALISED,
    payment_statuses: Sequence[str] | None = SETTLED,
) -> DataFrame:
    """(order_id, attributes..., grand_total) of the chosen orders; the base of all revenue."""
    chosen = orders.filter(F.col("order_status").isin(*statuses)).select("order_id", *attributes)
    if payment_statuses is not None:
        payments = payments.filter(F.col("payment_status").isin(*payment_statuses))
    return chosen.join(payments.select("order_id", "grand_total"), "order_id")


def fact_orders(
    orders: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame | None,
) -> DataFrame:
    """The orders of the fact table, each once: those of a known customer, with a payment, and
    with a line of a known product.

    Order ids are made distinct on the line side first, which shrinks an order with very many
    lines to one row per task before it is shuffled.  Leave ``customers`` out to test them later,
    on rows per customer.
    """
    known = order_items.select("order_id", "product_id").join(
        products.select("product_id"), "product_id", "left_semi"
    )
    present = orders.join(known.select("order_id").distinct(), "order_id", "left_semi").join(
        payments.select("order_id"), "order_id", "left_semi"
    )
    if customers is None:
        return present
    return present.join(customers.select("customer_id"), "customer_id", "left_semi")


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status and their share of all orders."""
    counts = orders.groupBy("order_status").agg(F.count("*").alias("order_count"))
    return (
        counts.withColumn("total", counts.agg(F.sum("order_count")).scalar())
        .withColumn("percentage", percentage(F.col("order_count"), F.col("total")))
        .drop("total")
        .orderBy(F.desc("order_count"), "order_status")
    )


def status_counts(
    orders: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Orders per status among those present in the fact table (paid for in any way)."""
    return (
        fact_orders(orders, payments, order_items, products, customers)
        .groupBy("order_status")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "order_status")
    )


def total_revenue(
    orders: DataFrame,
    payments: DataFrame,
    statuses: Sequence[str] = REALISED,
    payment_statuses: Sequence[str] | None = SETTLED,
) -> DataFrame:
    """Revenue of the chosen order and payment statuses (None: paid or not), one row."""
    chosen = order_totals(
        orders, payments, statuses=statuses, payment_statuses=payment_statuses
    )
    return chosen.agg(money(F.sum("grand_total")).alias("total_revenue"))


def monthly_revenue(
    orders: DataFrame,
    payments: DataFrame,
    statuses: Sequence[str] = REALISED,
    payment_statuses: Sequence[str] | None = SETTLED,
) -> DataFrame:
    """Orders and revenue per month, of the chosen order and payment statuses."""
    return (
        order_totals(
            orders,
            payments,
            "order_date",
            statuses=statuses,
            payment_statuses=payment_statuses,
        )
        .groupBy(month_start().alias("month"))
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            money(F.sum("grand_total")).alias("monthly_revenue"),
        )
        .withColumn("month", month_text("month"))
        .orderBy("month")
    )


def channel_revenue(
    orders: DataFrame,
    payments: DataFrame,
    statuses: Sequence[str] = REALISED,
    payment_statuses: Sequence[str] | None = SETTLED,
) -> DataFrame:
    """Orders and revenue per month and sales channel, of the chosen statuses."""
    return (
        order_totals(
            orders,
            payments,
            "order_date",
            "channel",
            statuses=statuses,
            payment_statuses=payment_statuses,
        )
        .groupBy(month_start().alias("month"), "channel")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            money(F.sum("grand_total")).alias("revenue"),
        )
        .withColumn("month", month_text("month"))
        .orderBy("month", F.desc("revenue"), "channel")
    )


def daily_revenue(
    orders: DataFrame,
    payments: DataFrame,
    statuses: Sequence[str] = BILLED,
    payment_statuses: Sequence[str] | None = SETTLED,
) -> DataFrame:
    """Revenue per day, of the chosen order and payment statuses."""
    return (
        order_totals(
            orders,
            payments,
            "order_date",
            statuses=statuses,
            payment_statuses=payment_statuses,
        )
        .groupBy("order_date")
        .agg(money(F.sum("grand_total")).alias("revenue"))
        .orderBy("order_date")
    )


def monthly_revenue_chart(
    orders: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Billed and received revenue of the fact table's orders per month start."""
    billed = orders.filter(F.col("order_status").isin(*BILLED))
    present = fact_orders(billed, payments, order_items, products, customers)
    return (
        order_totals(present, payments, "order_date", statuses=BILLED)
        .groupBy(month_start().alias("order_month"))
        .agg(F.sum("grand_total").alias("grand_total"))
        .orderBy("order_month")
    )
