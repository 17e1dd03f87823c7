"""Operators on a small shop whose answers can be worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.shop import shop, texts
from tillroll.operators import (
    basket,
    customers,
    facts,
    operations,
    products,
    quality,
    revenue,
    rfm,
)
from tillroll.sources.schemas import TABLES, Star


@pytest.fixture(scope="module")
def star(spark):
    return shop(spark)


@pytest.fixture(scope="module")
def tables(star):
    return {name: getattr(star, name) for name in TABLES}


@pytest.fixture(scope="module")
def sales(star):
    return star.orders, star.order_items, star.products


@pytest.fixture(scope="module")
def empty(star):
    return Star(**{name: frame.limit(0) for name, frame in vars(star).items()})


def test_keys(tables):
    assert sorted(texts(quality.primary_keys(tables))) == [
        "customers customer_id C5 2",
        "order_items order_id,line_no O6,1 2",
    ]
    assert sorted(texts(quality.unique_columns(tables))) == [
        "customers email twin@example.com 2",
        "products sku S-2 2",
    ]
    assert texts(quality.duplicates(tables["customers"], ["email"])) == ["twin@example.com 2"]


def test_not_null(tables):
    found = quality.not_null(tables).filter("null_count > 0")
    assert texts(found) == ["products product_name 1"]


def test_foreign_keys(tables):
    assert sorted(texts(quality.foreign_keys(tables))) == [
        "order_items order_id orders O9 1",
        "order_items product_id products P9 1",
        "orders customer_id customers C9 1",
        "payments order_id orders O10 1",
    ]
    lineless = quality.foreign_keys(tables, [("orders", "order_id", "order_items")])
    assert texts(lineless, "missing_key") == ["O7"]


def test_defaults(spark, tables):
    loose = {
        "customers": spark.createDataFrame([(True,), (False,), (None,)], "is_active boolean"),
        "products": spark.createDataFrame([(None,), (None,)], "is_discontinued boolean"),
    }
    assert sorted(texts(quality.default_usage(loose))) == [
        "customers is_active False 1 0",
        "customers is_active True 2 1",
        "products is_discontinued False 2 2",
    ]
    # row batches take the default as they are loaded
    assert tables["customers"].filter("is_active is null").count() == 0
    assert texts(tables["products"].filter("product_id = 'P2'"), "is_discontinued") == ["False"]


def test_null_audit(star):
    assert texts(quality.status_null_audit(star.orders)) == [
        "Cancelled 1 1 0",
        "Delivered 6 1 5",
        "Returned 1 0 1",
    ]


def test_row_counts(tables):
    counted = quality.row_counts(tables, {"orders": 8, "payments": 10})
    found = {r["table_name"]: r["as_expected"] for r in counted.collect()}
    assert found == {
        "customers": None,
        "products": None,
        "orders": True,
        "order_items": None,
        "payments": False,
    }


def test_preview(star):
    shown = quality.preview(star.orders, 2, ["order_id"])
    assert texts(shown, "order_id", "row_count", "column_count") == ["O1 8 10", "O2 8 10"]


def test_revenue_needs_delivery_and_payment(star):
    assert texts(revenue.total_revenue(star.orders, star.payments)) == ["1364.00"]
    assert texts(revenue.monthly_revenue(star.orders, star.payments)) == [
        "2024-01 3 490.00",
        "2024-04 2 874.00",
    ]
    assert texts(revenue.daily_revenue(star.orders, star.payments)) == [
        "2024-01-05 390.00",
        "2024-01-20 100.00",
        "2024-01-31 200.00",
        "2024-04-01 70.00",
        "2024-04-02 804.00",
    ]


def in_facts(star):
    """What tells which orders are in the fact table."""
    return star.orders, star.payments, star.order_items, star.products, star.customers


def test_statuses_can_be_chosen(star):
    unpaid_too = {"payment_statuses": None}
    total = revenue.total_revenue(star.orders, star.payments, **unpaid_too)
    assert texts(total) == ["1463.20"]
    returned = revenue.channel_revenue(star.orders, star.payments, statuses=["Returned"])
    assert texts(returned) == ["2024-01 Web 1 200.00"]
    days = revenue.daily_revenue(star.orders, star.payments, ["Delivered"], ["Failed"])
    assert texts(days) == ["2024-02-01 99.20"]
    months = revenue.monthly_revenue(star.orders, star.payments, ["Returned"])
    assert texts(months) == ["2024-01 1 200.00"]


def test_reports_equal_aggregates_of_the_fact_table(star):
    one_each = star.customers.dropDuplicates(["customer_id"])
    tables = (star.orders, star.payments, star.order_items, star.products, one_each)
    fact = facts.fact_table(
        Star(one_each, star.products, star.orders, star.order_items, star.payments)
    )
    once = fact.dropDuplicates(["order_id"])
    by_status = {tuple(r) for r in once.groupBy("order_status").count().collect()}
    assert {tuple(r) for r in revenue.status_counts(*tables).collect()} == by_status
    paid = once.filter("order_status = 'Delivered' and payment_status = 'Paid'")
    spend = {r[0]: r[1] for r in paid.groupBy("customer_id").sum("grand_total").collect()}
    base = rfm.rfm_base(*tables).collect()
    assert {r["customer_id"]: r["monetary"] for r in base} == spend


def test_chart_counts_orders_with_lines(star):
    charted = revenue.monthly_revenue_chart(*in_facts(star))
    assert texts(charted) == ["2024-01-01 690.00"]


def test_status(star, empty):
    assert texts(revenue.status_distribution(star.orders)) == [
        "Delivered 6 75.00",
        "Cancelled 1 12.50",
        "Returned 1 12.50",
    ]
    counted = revenue.status_counts(*in_facts(star))
    assert texts(counted) == ["Delivered 4", "Cancelled 1", "Returned 1"]
    assert texts(revenue.status_distribution(empty.orders)) == []


def test_repeat_rate(star, empty):
    assert texts(customers.repeat_rate(star.orders)) == ["2 3 66.67"]
    assert texts(customers.repeat_rate(empty.orders)) == ["0 0 None"]
    twice = star.orders.filter("order_id = 'O8'")
    assert texts(customers.repeat_rate(twice.unionAll(twice))) == ["0 1 0.00"]


def test_cohorts(star):
    one_each = star.customers.dropDuplicates(["customer_id"])
    assert texts(customers.cohort_retention(one_each, star.orders)) == [
        "2023-12 1 1",
        "2023-12 2 1",
        "2024-01 0 1",
        "2024-01 3 1",
    ]


def test_cohort_before_signup(spark, star):
    orders = star.orders.filter("order_id = 'O1'")
    late = star.customers.filter("customer_id = 'C1'").selectExpr(
        "customer_id", "date'2024-03-31' as signup_date"
    )
    assert texts(customers.cohort_retention(late, orders)) == ["2024-03 -2 1"]


def test_top_customers_ignores_unknown(star):
    one_each = star.customers.dropDuplicates(["customer_id"])
    top = customers.top_customers(one_each, star.orders, star.payments)
    assert texts(top, "customer_id", "total_orders", "lifetime_revenue") == [
        "C1 2 390.00",
        "C3 2 170.00",
    ]


def test_running_spend(star):
    spend = customers.running_spend(star.customers, star.orders, star.payments)
    assert texts(spend.orderBy("customer_id", "order_number")) == [
        "C1 O1 2024-01-05 1 290.00",
        "C1 O2 2024-01-05 2 390.00",
        "C3 O6 2024-01-20 1 100.00",
        "C3 O7 2024-04-01 2 170.00",
    ]


def test_history(star):
    as_of = datetime.date(2024, 4, 11)
    shown = customers.customer_history(star.customers, star.orders, star.payments, as_of)
    assert texts(shown) == [
        "C1 Ann 2024-01-05 2024-01-05 97 2 390.00",
        "C3 Cid 2024-01-20 2024-04-01 10 2 170.00",
    ]


def test_categories(sales, star):
    assert texts(products.category_revenue(*sales)) == [
        "Home 4 7 1228.20",
        "Sports 3 8 140.00",
        "Books 1 2 20.00",
    ]
    assert texts(products.category_quantity(*sales)) == [
        "Sports 8 140.00",
        "Home 7 1228.20",
        "Books 2 20.00",
    ]
    one_each = star.customers.dropDuplicates(["customer_id"])
    chart = products.top_categories_chart(
        star.orders, star.payments, star.order_items, star.products, one_each, limit=1
    )
    assert texts(chart) == ["Home 429.20 6"]


def test_discount_skips_unpriced_lines(sales):
    impact = products.discount_impact(*sales)
    assert texts(impact) == [
        "Home Lux 2 5.06 11.00",  # (10 + 0.125) / 2
        "Home Wove 2 0.40 0.40",
        "Books Page 1 0.00 0.00",
        "Sports Kick 2 0.00 0.00",
    ]


def test_profit_with_missing_cost(sales):
    shown = products.top_profit(*sales)
    assert texts(shown, "product_id", "units_sold", "estimated_profit") == [
        "P1 4 839.00",  # 60 + 40 + 739
        "P2 3 119.20",
        "P3 8 -60.00",
        "P4 2 None",
    ]


def test_profit_skips_lines_without_price(star):
    unpriced = star.order_items.withColumn(
        "unit_price", F.expr("case when order_id <> 'O8' then unit_price end")
    )
    shown = products.top_profit(star.orders, unpriced, star.products, limit=1)
    assert texts(shown, "product_id", "units_sold", "estimated_profit") == ["P2 3 119.20"]


def test_rank_ties(spark, star):
    items = spark.createDataFrame(
        [("O1", "P1", 1, 10.0), ("O1", "P3", 1, 10.0), ("O1", "P4", 1, 4.0)],
        "order_id string, product_id string, quantity int, unit_price double",
    ).withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)"))
    ranked = products.category_rank(star.orders, items, star.products)
    assert texts(ranked) == [
        "2024-01 Home 10.00 1",
        "2024-01 Sports 10.00 1",
        "2024-01 Books 4.00 2",
    ]


def test_delivery_needs_a_date(star):
    assert texts(operations.delivery_time(star.orders)) == ["Slow 3 1.67 1 2", "Fast 2 2.00 1 3"]


def test_return_rates(star, sales):
    assert texts(operations.return_rate_by_carrier(star.orders)) == [
        "Slow 4 1 25.00",
        "Fast 3 0 0.00",
    ]
    rates = operations.return_rate_carrier_chart(*in_facts(star))
    assert texts(rates) == ["Slow 2 1 50.00", "Fast 4 0 0.00"]
    # two returned lines in one order count twice against orders, once as an order
    assert texts(operations.return_rate_by_category(*sales))[0] == "Home 5 2 40.00"
    assert texts(operations.return_rate_by_category_orders(*sales))[0] == "Home 5 1 20.00"


def test_cancellations(star):
    assert texts(operations.cancellation_by_payment(star.orders)) == [
        "UPI 3 1 33.33",
        "COD 2 0 0.00",
        "Card 3 0 0.00",
    ]
    assert texts(operations.cancellation_cod_prepaid(star.orders)) == [
        "COD 2 0 0.00",
        "Prepaid 6 1 16.67",
    ]


def test_basket(sales):
    assert texts(basket.basket_pairs(*sales)) == ["Home Sports 2 33.33", "Books Sports 1 16.67"]
    assert texts(basket.basket_pairs(*sales, limit=1)) == ["Home Sports 2 33.33"]


def test_basket_without_orders(empty):
    shown = basket.basket_pairs(empty.orders, empty.order_items, empty.products)
    assert texts(shown) == []


def test_facts(star):
    one_each = Star(**{**vars(star), "customers": star.customers.dropDuplicates(["customer_id"])})
    fact = facts.fact_table(one_each)
    assert fact.columns == list(facts.FACT_COLUMNS)
    assert fact.count() == 11
    shown = facts.derived(fact).filter("order_id = 'O2'").orderBy("line_no")
    assert texts(
        shown, "revenue", "profit", "discount_pct", "delivery_days", "order_month"
    ) == ["0.00 -25.00 None None 2024-01-01", "100.00 40.00 None None 2024-01-01"]
    mobile = facts.fact_query(one_each, channel="Mobile", category="Home")
    assert sorted(texts(mobile, "order_id")) == [
        "O3",
        "O5",
    ]
    ranged = facts.fact_query(
        one_each, start=datetime.date(2024, 1, 31), end=datetime.date(2024, 2, 1)
    )
    assert sorted(texts(ranged, "order_id")) == ["O3", "O4", "O4"]
    assert facts.fact_sample(one_each, 3).count() == 3
    assert facts.fact_sample(one_each, 3, ordered=False).count() == 3
    summary = dict(map(tuple, quality.null_summary(facts.derived(fact)).collect()))
    assert dict(map(tuple, facts.fact_null_summary(one_each).collect())) == summary
    assert summary == {
        "delivered_date": 3,
        "delivery_days": 3,
        "product_name": 1,
        "unit_cost": 1,
        "profit": 1,
        "item_list_price": 1,
        "discount_amount": 1,
        "discount_pct": 2,
    }


def test_cohort_without_signup(spark, star):
    buyers = star.customers.filter("customer_id = 'C1'").selectExpr(
        "customer_id", "cast(null as date) as signup_date"
    )
    assert texts(customers.cohort_retention(buyers, star.orders)) == ["None None 1"]


def test_pairs_with_least_support(spark, star):
    sales = star.orders, star.order_items, star.products
    every = texts(basket.basket_pairs(*sales))
    frequent = texts(basket.basket_pairs(*sales, min_orders=2))
    assert frequent == [row for row in every if int(row.split()[2]) >= 2] and frequent != every
