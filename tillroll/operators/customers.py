"""Customer value, repeat purchase, cohorts, order history."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import DELIVERED, money, month_start, month_text, percentage
from tillroll.functions.ranges import running_totals
from tillroll.operators.revenue import order_totals


def top_customers(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, limit: int = 10
) -> DataFrame:
    """Customers with the highest lifetime revenue.

    Orders are summed per customer before names are attached: a heavy customer shrinks to one
    row per task, and only one row per customer meets the customer table.
    """
    per_customer = (
        order_totals(orders, payments, "customer_id")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money(F.sum("grand_total")).alias("lifetime_revenue"),
        )
    )
    return (
        per_customer.join(
            customers.select("customer_id", "full_name", "city", "segment"), "customer_id"
        )
        .select(
            "customer_id", "full_name", "city", "segment", "total_orders", "lifetime_revenue"
        )
        .orderBy(F.desc("lifetime_revenue"), "customer_id")
        .limit(limit)
    )


def repeat_rate(orders: DataFrame) -> DataFrame:
    """Share of buying customers with at least two delivered orders, one row.

    Orders are made distinct and counted by hash aggregation, whatever the type of the ids.
    """
    return (
        orders.filter(F.col("order_status") == DELIVERED)
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("orders"))
        .agg(
            F.count_if(F.col("orders") > 1).alias("repeat_customers"),
            F.count("*").alias("total_customers"),
        )
        .withColumn(
            "repeat_rate_pct", percentage(F.col("repeat_customers"), F.col("total_customers"))
        )
    )


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers of each signup month active in each later month; those without a signup date
    are one cohort without months.

    Orders are first reduced to one row per customer and month, on the map side too, so a
    customer with very many orders reaches the join as a handful of rows.
    """
    active = (
        orders.filter(F.col("order_status") == DELIVERED)
        .select("customer_id", month_start("order_date").alias("active_month"))
        .distinct()
    )
    signups = customers.select("customer_id", month_start("signup_date").alias("signup_month"))
    return (
        active.join(signups, "customer_id")
        .groupBy(
            month_text("signup_month").alias("cohort_month"),
            # a whole number, as both are month starts
            F.months_between("active_month", "signup_month")
            .cast("bigint")
            .alias("months_since_signup"),
        )
        .agg(F.count_distinct("customer_id").alias("active_customers"))
        .orderBy("cohort_month", "months_since_signup")
    )


def customer_history(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, as_of: datetime.date
) -> DataFrame:
    """First and last order, days since, number of orders and value of every buying customer.

    The running total's last value is the sum, so a plain aggregate replaces the window.
    """
    per_customer = (
        order_totals(orders, payments, "customer_id", "order_date")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count("*").alias("total_orders"),
            money(F.sum("grand_total")).alias("lifetime_value"),
        )
    )
    return (
        per_customer.join(customers.select("customer_id", "full_name"), "customer_id")
        .select(
            "customer_id",
            "full_name",
            "first_order_date",
            "last_order_date",
            F.datediff(F.lit(as_of), "last_order_date").alias("days_since_last_order"),
            "total_orders",
            "lifetime_value",
        )
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )


def running_spend(
    customers: DataFrame, orders: DataFrame, payments: DataFrame
) -> DataFrame:
    """Every paid, delivered order of a known customer with its number and the customer's spend
    so far.

    Same-day orders follow their order id.
    """
    spend = order_totals(orders, payments, "customer_id", "order_date").join(
        customers.select("customer_id"), "customer_id", "left_semi"
    )
    return running_totals(
        spend,
        group="customer_id",
        order=["order_date", "order_id"],
        amount="grand_total",
        number_as="order_number",
        total_as="running_total_spend",
    ).select("customer_id", "order_id", "order_date", "order_number", "running_total_spend")
