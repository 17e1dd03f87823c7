"""Summaries that can be put together: mergeable sketches, and totals on all levels of a cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12  # of a distinct count; its standard error is 1.04 / sqrt(2 ** 12), or 1.6 %
RANK_SIZE = 200  # of a quantile sketch; ranks are within 1.33 % with 99 % confidence


def sketched(rows: DataFrame, period: str, ids: str, amounts: str) -> DataFrame:
    """A row for each period: ``rows`` counted, a sketch of the different ids and one of the
    amounts, as bytes that can be stored and merged."""
    return rows.groupBy(period).agg(
        F.count("*").alias("rows"),
        F.hll_sketch_agg(ids, F.lit(LOG_BUCKETS)).alias("ids_sketch"),
        F.kll_sketch_agg_double(F.col(amounts).cast("double"), F.lit(RANK_SIZE)).alias(
            "amounts_sketch"
        ),
    )


def merged(sketches: DataFrame, period: Column, name: str) -> DataFrame:
    """Sketches of longer periods from those of shorter ones, without their rows."""
    return sketches.groupBy(period.alias(name)).agg(
        F.sum("rows").alias("rows"),
        F.hll_union_agg("ids_sketch").alias("ids_sketch"),
        F.kll_merge_agg_double("amounts_sketch").alias("amounts_sketch"),
    )


def distinct_estimate(sketch: str = "ids_sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_estimate(rank: float, sketch: str = "amounts_sketch") -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))


def sales_cube(orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and different orders for every combination of region, category and year, with each
    of them also left open (marked in ``all_...``).

    An order has one region and one year, so its lines are summed once by order and category; the
    cells of region, category and year that follow are as few as their combinations, and only they
    are expanded to all levels.  Counting orders by cells is exact: with the category given, an
    order is one row of its cell, and without it orders are counted by region and year alone.
    """
    sold = (
        lines.select(
            "order_id", "product_id", (F.col("quantity") * F.col("unit_price")).alias("amount")
        )
        .join(orders.select("order_id", "ship_state", F.year("order_date").alias("year")), "order_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("order_id", "ship_state", "year", "category")
        .agg(F.sum("amount").alias("amount"))
    )
    cells = sold.groupBy("ship_state", "year", "category").agg(
        F.count("*").alias("orders"), F.sum("amount").alias("revenue")
    )
    whole = (
        sold.groupBy("order_id", "ship_state", "year")
        .agg(F.sum("amount").alias("amount"))
        .groupBy("ship_state", "year")
        .agg(F.count("*").alias("orders"), F.sum("amount").alias("revenue"))
    )

    def levels(df: DataFrame, *dimensions: str) -> DataFrame:
        flags = [F.grouping(d).cast("int").alias(f"all_{d}") for d in dimensions]
        return df.cube(*dimensions).agg(
            F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"), *flags
        )

    by_category = levels(cells, "ship_state", "year", "category").filter("all_category = 0")
    open_category = levels(whole, "ship_state", "year").withColumns(
        {"category": F.lit(None).cast("string"), "all_category": F.lit(1)}
    )
    return by_category.unionByName(open_category)
