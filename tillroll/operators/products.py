"""Category and product revenue, discounts, profit, category ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import (
    DELIVERED,
    line_revenue,
    mean_discount_pct,
    money,
    month_start,
    month_text,
)


def sold_lines(
    orders: DataFrame,
    order_items: DataFrame,
    *order_attributes: str,
    statuses: tuple[str, ...] = (DELIVERED,),
) -> DataFrame:
    """Lines of the chosen orders, with the wanted order attributes.

    This is the one shuffle of the lines, on the order; products are attached afterwards, to the
    remaining lines only.  Catalyst broadcasts the products if their size allows it.
    """
    chosen = orders.filter(F.col("order_status").isin(*statuses))
    return order_items.join(chosen.select("order_id", *order_attributes), "order_id")


def category_totals(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders, quantity and revenue per category, unsorted.

    Lines are summed per order and category first, on the join's partitioning, which turns the
    distinct order count into a plain count.
    """
    lines = sold_lines(
        orders, order_items.select("order_id", "product_id", "quantity", "unit_price")
    )
    per_order = (
        lines.join(products.select("product_id", "category"), "product_id")
        .groupBy("order_id", "category")
        .agg(F.sum("quantity").alias("quantity"), F.sum(line_revenue()).alias("revenue"))
    )
    return per_order.groupBy("category").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        money(F.sum("revenue")).alias("category_revenue"),
    )


def category_revenue(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Categories by revenue."""
    return category_totals(orders, order_items, products).orderBy(
        F.desc("category_revenue"), "category"
    )


def category_quantity(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Categories by quantity sold."""
    return _category_sums(orders, order_items, products).select(
        "category",
        F.col("quantity").alias("total_quantity_sold"),
        F.col("revenue").alias("category_revenue"),
    ).orderBy(F.desc("total_quantity_sold"), "category")


def top_categories_chart(
    orders: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    limit: int = 8,
) -> DataFrame:
    """The leading categories by revenue among the fact table's delivered lines, with revenue and
    quantity.  Orders are tested for a customer and a payment before lines are joined."""
    present = (
        orders.filter(F.col("order_status") == DELIVERED)
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .join(payments.select("order_id"), "order_id", "left_semi")
    )
    return (
        _category_sums(present, order_items, products)
        .select("category", "revenue", "quantity")
        .orderBy(F.desc("revenue"), "category")
        .limit(limit)
    )


def _category_sums(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and revenue per category, where orders need not be counted."""
    lines = sold_lines(
        orders, order_items.select("order_id", "product_id", "quantity", "unit_price")
    )
    return (
        lines.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("quantity").alias("quantity"), money(F.sum(line_revenue())).alias("revenue")
        )
    )


def discount_impact(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Mean discount percentage over lines, and discount given, per category and brand."""
    lines = sold_lines(
        orders,
        order_items.filter(F.col("list_price") > 0).select(
            "order_id", "product_id", "list_price", "discount_amount"
        ),
    )
    return (
        lines.join(products.select("product_id", "category", "brand"), "product_id")
        .groupBy("category", "brand")
        .agg(
            F.count("*").alias("line_items"),
            mean_discount_pct().alias("avg_discount_pct"),
            money(F.sum("discount_amount")).alias("total_discount_given"),
        )
        .orderBy(F.desc("avg_discount_pct"), "category", "brand")
    )


def top_profit(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, limit: int = 10
) -> DataFrame:
    """Products with the highest estimated margin.

    The sum of (price - cost) * quantity is split into revenue and costed quantity, so lines can
    be summed per product before the product table is joined.
    """
    lines = sold_lines(
        orders, order_items.select("order_id", "product_id", "quantity", "unit_price")
    )
    per_product = lines.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(line_revenue()).alias("revenue"),
        # lines without a price contribute neither revenue nor cost
        F.sum(F.when(F.col("unit_price").isNotNull(), F.col("quantity"))).alias("costed_units"),
    )
    profit = F.col("revenue") - F.col("unit_cost") * F.col("costed_units")
    return (
        per_product.join(
            products.select("product_id", "product_name", "category", "brand", "unit_cost"),
            "product_id",
        )
        .select(
            "product_id",
            "product_name",
            "category",
            "brand",
            "units_sold",
            money(profit).alias("estimated_profit"),
        )
        .orderBy(F.desc("estimated_profit"), "product_id")
        .limit(limit)
    )


def category_rank(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Dense rank of the categories of each month by revenue.

    The window runs over the monthly sums, a few rows per month, not over lines.
    """
    lines = sold_lines(
        orders,
        order_items.select("order_id", "product_id", "quantity", "unit_price"),
        "order_date",
    )
    monthly = (
        lines.join(products.select("product_id", "category"), "product_id")
        .groupBy(month_start().alias("month"), "category")
        .agg(money(F.sum(line_revenue())).alias("revenue"))
        .withColumn("month", month_text("month"))
    )
    best_first = Window.partitionBy("month").orderBy(F.desc("revenue"))
    return monthly.withColumn("revenue_rank", F.dense_rank().over(best_first)).orderBy(
        "month", "revenue_rank", "category"
    )
