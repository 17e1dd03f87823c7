"""Plan shape: what reaches the scans, what is shuffled, how hot keys are split."""

import re
from contextlib import contextmanager

import pytest

from tests.shop import texts
from tillroll.operators import basket, facts, operations, products, revenue
from tillroll.plans import catalog
from tillroll.sources.schemas import Star

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def plan(df):
    """The physical plan; the final one as well once ``df`` has been run."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_single_task_or_python_work(spark, name):
    with settings(spark, NO_BROADCAST):
        text = plan(catalog.queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "NestedLoop", "PythonUDF", "InPandas", "InArrow"):
        assert unwanted not in text
    # a window over everything would need all rows in one task
    for window in re.findall(r"Window \[.*", text):
        assert re.search(r"\], \[\w+#\d+.*?\], \[", window), window


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize(
    "name,shuffles",
    [
        ("q03_status_dist", 2),  # the total reads the counts again, run as a reused exchange
        ("q04_total_revenue", 2),  # both sides of the join; the sum is one row per task
        ("q05_monthly_revenue", 3),  # and the months; the distinct count needs none
        ("q06_channel_month", 3),
        ("q08_repeat_rate", 2),  # orders made distinct, then counted per customer
        # orders, payments, sums; customers, once by nation and once by id; the two lookups
        ("q07_top_customers", 8),
        ("q17_customer_history", 4),
        ("rfm_segment_counts", 1),  # over the stored customer table
        ("line_revenue", 0),
    ],
)
def test_shuffles(spark, name, shuffles):
    with settings(spark, NO_BROADCAST):
        text = plan(catalog.queries()[name](spark, FOLDER))
    assert exchanges(text) == shuffles, text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.queries()["q05_monthly_revenue"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "GreaterThanOrEqual(o_totalprice,50000.0)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>", text)
    assert "lineitem" not in text and "customer.parquet" not in text


@pytest.fixture(scope="module")
def lopsided(spark):
    """One order, one product and one customer each hold a third of their rows."""
    rows = 120_000
    orders = spark.range(rows // 4).selectExpr(
        "id as order_id",
        "if(id % 3 = 0, 7, id % 5000) as customer_id",
        "date_add(date'2024-01-01', cast(id % 360 as int)) as order_date",
        "'Web' as channel",
        "'COD' as payment_method",
        "concat('carrier ', id % 4) as ship_carrier",
        "case when id % 10 < 8 then 'Delivered' when id % 10 < 9 then 'Returned' "
        "else 'Cancelled' end as order_status",
        "date_add(date'2024-01-03', cast(id % 360 as int)) as delivered_date",
    )
    items = spark.range(rows).selectExpr(
        "if(id % 3 = 0, 11, id div 4) as order_id",
        "cast(id as int) as line_no",
        "if(id % 3 = 1, 5, id % 4000) as product_id",
        "cast(1 + id % 3 as int) as quantity",
        "cast(100 + id % 50 as decimal(10,2)) as list_price",
        "cast(id % 7 as decimal(10,2)) as discount_amount",
        "cast(100 + id % 50 - id % 7 as decimal(10,2)) as unit_price",
    )
    goods = spark.range(4000).selectExpr(
        "id as product_id",
        "concat('item ', id) as product_name",
        "concat('category ', id % 9) as category",
        "'any' as sub_category",
        "concat('brand ', id % 11) as brand",
        "cast(20 as decimal(10,2)) as unit_cost",
    )
    payments = spark.range(rows // 4).selectExpr(
        "id as order_id",
        "'COD' as payment_method",
        "cast(id % 1000 as decimal(12,2)) as grand_total",
        "cast(0 as decimal(12,2)) as tax_amount",
        "cast(0 as decimal(12,2)) as shipping_fee",
        "if(id % 20 = 0, 'Failed', 'Paid') as payment_status",
    )
    people = spark.range(5000).selectExpr(
        "id as customer_id",
        "concat('customer ', id) as full_name",
        "'city' as city",
        "'state' as state",
        "30 as age",
        "'Consumer' as segment",
        "date'2023-12-01' as signup_date",
    )
    return Star(people, goods, orders, items, payments)


def sales(star):
    return star.orders, star.order_items, star.products


LINE_REPORTS = {
    "category_revenue": lambda s: products.category_revenue(*sales(s)),
    "category_quantity": lambda s: products.category_quantity(*sales(s)),
    "discount_impact": lambda s: products.discount_impact(*sales(s)),
    "top_profit": lambda s: products.top_profit(*sales(s)),
    "category_rank": lambda s: products.category_rank(*sales(s)),
    "returns": lambda s: operations.return_rate_by_category(*sales(s)),
    "basket": lambda s: basket.basket_pairs(*sales(s)),
    "fact_table": lambda s: facts.fact_table(s)
    .groupBy("ship_carrier", "payment_status")
    .agg({"grand_total": "sum", "quantity": "sum", "line_no": "max", "discount_amount": "sum"})
    .orderBy("ship_carrier", "payment_status"),
}


# the small tables may be broadcast in one run, and nothing at all in the other
@pytest.mark.parametrize("broadcast_below", ["-1", "100KB"])
@pytest.mark.parametrize("name", sorted(LINE_REPORTS))
def test_hot_order_is_split(spark, lopsided, name, broadcast_below):
    split = {
        "spark.sql.autoBroadcastJoinThreshold": broadcast_below,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with settings(spark, split):
        report = LINE_REPORTS[name](lopsided)
        found = texts(report)
        assert re.search(r"SortMergeJoin\(skew=true\) \[order_id#", plan(report)), plan(report)
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        assert texts(LINE_REPORTS[name](lopsided)) == found


def test_lines_of_a_hot_order_are_not_all_shuffled(spark, lopsided):
    """Order ids are made distinct on the map side before the semi join."""
    with settings(spark, NO_BROADCAST):
        text = plan(
            revenue.fact_orders(
                lopsided.orders,
                lopsided.payments,
                lopsided.order_items,
                lopsided.products,
                lopsided.customers,
            )
        )
    distinct = r"HashAggregate\(keys=\[order_id#\d+L?\]"
    assert re.search(distinct + r".*\n.*Exchange.*\n.*" + distinct, text), text


def ancestors(text, scan):
    """For each scan with this text, the operators above it up to the first shuffle."""
    lines = text.split("\n")
    depth = [len(re.match(r"[\s:|+*()0-9-]*", line)[0].rstrip("*(0123456789) ")) for line in lines]
    for place, line in enumerate(lines):
        if scan not in line:
            continue
        above, level = [], depth[place]
        for upper in range(place - 1, -1, -1):
            if depth[upper] < level:
                level = depth[upper]
                above.append(lines[upper])
                if "Exchange hashpartitioning" in lines[upper]:
                    break
        yield above


@pytest.mark.parametrize("name", ["param_query"])
def test_lines_of_other_orders_are_not_shuffled(spark, name):
    """A few chosen orders are broadcast, so other orders' lines go before any shuffle."""
    query = catalog.queries()[name](spark, FOLDER)
    query.collect()
    text = plan(query).split("== Initial Plan ==")[0]
    paths = list(ancestors(text, "FileScan parquet [l_orderkey"))
    assert paths
    for above in paths:
        assert any("LeftSemi" in line for line in above), "\n".join(above)
