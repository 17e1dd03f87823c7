"""Categories bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import DELIVERED, percentage
from tillroll.operators.products import sold_lines


def basket_pairs(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    column: str = "category",
    limit: int = 20,
    min_orders: int = 1,
) -> DataFrame:
    """Most frequent unordered pairs in one delivered order, and their share of such orders.

    Orders and values are made distinct by hash aggregation, then every order becomes its sorted
    list of values; equal lists are counted first and pairs are formed once per different list,
    weighted by that count.  No order is paired with itself, and the number of pairs formed does
    not grow with the number of orders once all lists occur.

    With ``min_orders`` only pairs in at least so many orders are wanted.  A pair is in no more
    orders than either of its values, so rarer values go before pairs are formed; ask for it
    where ``column`` has very many values, which a large order would otherwise pair in full.
    """
    bought = (
        sold_lines(orders, order_items.select("order_id", "product_id"))
        .join(products.select("product_id", F.col(column).alias("item")), "product_id")
        .filter(F.col("item").isNotNull())
        .select("order_id", "item")
        .distinct()
    )
    if min_orders > 1:
        frequent = bought.groupBy("item").agg(F.count("*").alias("n"))
        bought = bought.join(
            frequent.filter(F.col("n") >= min_orders).select("item"), "item", "left_semi"
        )
    baskets = (
        bought.groupBy("order_id")
        .agg(F.array_sort(F.collect_list("item")).alias("basket"))
        .filter(F.size("basket") > 1)
        .groupBy("basket")
        .agg(F.count("*").alias("weight"))
    )
    pairs = (
        baskets.select("weight", "basket", F.posexplode("basket").alias("place", "category_1"))
        .select(
            "weight",
            "category_1",
            F.explode(F.expr("slice(basket, place + 2, size(basket))")).alias("category_2"),
        )
        .groupBy("category_1", "category_2")
        .agg(F.sum("weight").alias("pair_count"))
        .filter(F.col("pair_count") >= min_orders)
    )
    delivered = orders.filter(F.col("order_status") == DELIVERED).agg(F.count("*"))
    return (
        pairs.withColumn("delivered", delivered.scalar())
        .withColumn("pct_of_orders", percentage(F.col("pair_count"), F.col("delivered")))
        .drop("delivered")
        .orderBy(F.desc("pair_count"), "category_1", "category_2")
        .limit(limit)
    )
