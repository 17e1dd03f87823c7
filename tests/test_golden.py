"""Known results on the canonical 250-customer data set.

The data is not kept here: pass a folder with customers.csv, products.csv, orders.csv,
order_items.csv and payments.csv as ``--golden-dir``.  Without it these tests are left out of the
run; test_shop.py holds the same operators to hand-computed results that always run.
"""

import datetime
from decimal import Decimal

import pytest

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
from tillroll.sources import files
from tillroll.sources.schemas import TABLES, Star

AS_OF = datetime.date(2026, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, request):
    folder = request.config.getoption("--golden-dir")
    loaded = {t: files.read_csv(spark, f"{folder}/{t}.csv", t) for t in TABLES}
    for frame in loaded.values():
        assert files.rejected(frame).count() == 0
    return {t: files.accepted(frame).cache() for t, frame in loaded.items()}


@pytest.fixture(scope="module")
def star(tables):
    return Star(**tables)


@pytest.fixture(scope="module")
def sales(star):
    return star.orders, star.order_items, star.products


@pytest.fixture(scope="module")
def paid(star):
    return star.orders, star.payments


def in_facts(star):
    return star.orders, star.payments, star.order_items, star.products, star.customers


@pytest.fixture(scope="module")
def base(star):
    return rfm.rfm_base(*in_facts(star))


@pytest.fixture(scope="module")
def segmented(base):
    return rfm.rfm_segment(rfm.rfm_scores(base))


def rows(df, *columns):
    """Rows as text, in result order."""
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return [" ".join(str(v) for v in row) for row in picked.collect()]


def test_quality(tables):
    assert quality.duplicates(tables["customers"], ["email"]).count() == 0
    assert quality.primary_keys(tables).count() == 0
    assert quality.unique_columns(tables).count() == 0
    assert quality.foreign_keys(tables).count() == 0
    assert quality.not_null(tables).filter("null_count > 0").count() == 0
    assert rows(quality.status_null_audit(tables["orders"])) == [
        "Cancelled 57 57 0",
        "Delivered 800 0 800",
        "Returned 43 0 43",
    ]
    expected = dict(customers=250, products=120, orders=900, order_items=2682, payments=900)
    checked = quality.row_counts(tables, expected)
    assert checked.count() == 5 and checked.filter("not as_expected").count() == 0


def test_distribution(star):
    assert rows(revenue.status_distribution(star.orders)) == [
        "Delivered 800 88.89",
        "Cancelled 57 6.33",
        "Returned 43 4.78",
    ]
    counted = revenue.status_counts(*in_facts(star))
    assert rows(counted) == ["Delivered 800", "Cancelled 57", "Returned 43"]


def test_revenue(star, paid):
    assert rows(revenue.total_revenue(*paid)) == ["39195933.95"]
    monthly = rows(revenue.monthly_revenue(*paid))
    assert len(monthly) == 23
    assert monthly[:3] == ["2024-01 1 83062.32", "2024-03 3 394668.69", "2024-04 6 448169.09"]
    assert revenue.channel_revenue(*paid).count() == 63
    assert rows(revenue.daily_revenue(*paid))[:3] == [
        "2024-01-28 83062.32",
        "2024-03-02 29700.78",
        "2024-03-10 21786.16",
    ]
    assert rows(revenue.monthly_revenue_chart(*in_facts(star)))[:3] == [
        "2024-01-01 83062.32",
        "2024-03-01 424369.47",
        "2024-04-01 490793.70",
    ]


def test_customers(star, paid):
    top = customers.top_customers(star.customers, *paid)
    assert rows(top, "customer_id", "total_orders", "lifetime_revenue") == [
        "C0151 6 646040.62",
        "C0173 9 559609.69",
        "C0100 4 521844.44",
        "C0187 5 464158.66",
        "C0223 5 453516.42",
        "C0227 7 442762.90",
        "C0036 4 409717.42",
        "C0024 6 407569.06",
        "C0057 7 398399.68",
        "C0119 5 397377.81",
    ]
    assert rows(customers.repeat_rate(star.orders)) == ["209 242 86.36"]
    cohorts = rows(customers.cohort_retention(star.customers, star.orders))
    assert len(cohorts) == 255
    assert cohorts[:4] == ["2024-01 0 1", "2024-01 2 1", "2024-01 4 1", "2024-01 5 1"]
    history = customers.customer_history(star.customers, *paid, as_of=AS_OF)
    assert history.count() == 242
    assert rows(
        history.limit(2),
        "customer_id",
        "first_order_date",
        "last_order_date",
        "total_orders",
        "lifetime_value",
    ) == ["C0151 2025-04-26 2025-10-13 6 646040.62", "C0173 2025-10-21 2025-12-26 9 559609.69"]


def test_running_spend(star, paid):
    spend = customers.running_spend(star.customers, *paid)
    assert spend.count() == 800
    one = spend.filter("customer_id = 'C0151'").orderBy("order_number")
    assert rows(one, "running_total_spend") == [
        "70272.30",
        "100621.02",
        "166498.06",
        "212680.90",
        "292121.98",
        "646040.62",
    ]


def test_categories(sales, star):
    assert rows(products.category_revenue(*sales)) == [
        "Electronics 306 471 19302676.95",
        "Sports 310 513 5063790.75",
        "Home 256 393 3925391.85",
        "Fashion 285 436 2718254.45",
        "Beauty 313 490 1336705.80",
        "Grocery 268 413 469640.30",
        "Books 259 372 399534.90",
    ]
    assert rows(products.category_quantity(*sales), "category") == [
        "Sports",
        "Beauty",
        "Electronics",
        "Fashion",
        "Grocery",
        "Home",
        "Books",
    ]
    chart = products.top_categories_chart(*in_facts(star))
    assert rows(chart)[0] == "Electronics 19302676.95 471" and chart.count() == 7
    discounts = rows(products.discount_impact(*sales))
    assert len(discounts) == 31
    assert discounts[:3] == [
        "Electronics Astra 65 11.62 536171.75",
        "Beauty GlowUp 74 11.08 26787.65",
        "Grocery DairyCo 68 11.03 10039.80",
    ]
    profit = products.top_profit(*sales)
    assert rows(profit, "product_id", "units_sold", "estimated_profit") == [
        "P0018 30 721209.90",
        "P0074 28 561089.48",
        "P0056 20 546080.20",
        "P0084 39 474328.05",
        "P0044 24 437387.76",
        "P0038 20 369829.50",
        "P0036 32 346850.63",
        "P0001 28 308661.92",
        "P0099 27 301187.92",
        "P0061 24 276533.52",
    ]
    ranked = rows(products.category_rank(*sales))
    assert len(ranked) == 156
    assert ranked[:3] == [
        "2024-01 Electronics 64636.20 1",
        "2024-01 Beauty 5202.25 2",
        "2024-01 Grocery 553.35 3",
    ]


def test_operations(star, sales):
    assert rows(operations.delivery_time(star.orders)) == [
        "BlueDart 164 3.76 1 7",
        "DTDC 180 3.86 1 7",
        "XpressBees 156 3.87 1 7",
        "Delhivery 155 3.92 1 7",
        "EcomExpress 145 4.01 1 7",
    ]
    assert rows(operations.return_rate_by_carrier(star.orders)) == [
        "EcomExpress 156 11 7.05",
        "BlueDart 174 10 5.75",
        "DTDC 190 10 5.26",
        "Delhivery 163 8 4.91",
        "XpressBees 160 4 2.50",
    ]
    chart = operations.return_rate_carrier_chart(*in_facts(star))
    assert rows(chart) == [
        "EcomExpress 165 11 6.67",
        "BlueDart 186 10 5.38",
        "DTDC 204 10 4.90",
        "Delhivery 178 8 4.49",
        "XpressBees 167 4 2.40",
    ]
    assert rows(operations.return_rate_by_category(*sales)) == [
        "Books 275 23 8.36",
        "Home 271 20 7.38",
        "Sports 328 21 6.40",
        "Beauty 329 19 5.78",
        "Grocery 282 16 5.67",
        "Electronics 318 18 5.66",
        "Fashion 300 16 5.33",
    ]
    corrected = operations.return_rate_by_category_orders(*sales)
    assert rows(corrected, "category", "returned_orders", "return_rate_pct") == [
        "Books 16 5.82",
        "Home 15 5.54",
        "Sports 18 5.49",
        "Fashion 15 5.00",
        "Grocery 14 4.96",
        "Beauty 16 4.86",
        "Electronics 12 3.77",
    ]
    assert rows(operations.cancellation_by_payment(star.orders)) == [
        "Card 213 15 7.04",
        "UPI 419 27 6.44",
        "Wallet 80 5 6.25",
        "COD 93 5 5.38",
        "NetBanking 95 5 5.26",
    ]
    assert rows(operations.cancellation_cod_prepaid(star.orders)) == [
        "COD 93 5 5.38",
        "Prepaid 807 52 6.44",
    ]


def test_basket(sales):
    pairs = rows(basket.basket_pairs(*sales))
    assert len(pairs) == 20
    assert pairs[:5] == [
        "Beauty Sports 115 14.38",
        "Electronics Sports 113 14.13",
        "Beauty Electronics 106 13.25",
        "Grocery Sports 104 13.00",
        "Fashion Sports 103 12.88",
    ]


def test_facts(star):
    fact = facts.fact_table(star)
    assert (fact.count(), len(fact.columns)) == (2682, 29)
    wide = facts.derived(fact)
    assert len(wide.columns) == 34
    assert sorted(rows(quality.null_summary(wide))) == ["delivered_date 170", "delivery_days 170"]


def test_rfm(base, segmented):
    assert base.count() == 242
    described = {
        r["statistic"]: (r["recency"], r["frequency"], r["monetary"])
        for r in rfm.describe_metrics(base).collect()
    }
    assert described["count"] == (242, 242, 242)
    assert described["mean"] == (92.02, 3.31, 161966.67)
    assert described["std"] == (97.23, 1.65, 119059.83)
    assert described["min"] == (1, 1, 202.54)
    assert described["max"] == (442, 9, 646040.62)
    assert [described[q][0] for q in ("25%", "50%", "75%")] == [21.25, 53, 135.25]
    assert rows(rfm.rfm_segment_counts(segmented)) == [
        "Potential 73",
        "Loyal 69",
        "Champions 61",
        "At-Risk 39",
    ]
    assert rows(rfm.rfm_segment_summary(segmented)) == [
        "Potential 73 95956.93 2.32",
        "Loyal 69 184107.17 3.71",
        "Champions 61 290842.41 5.15",
        "At-Risk 39 44776.83 1.56",
    ]


def test_money_is_rounded_on_load(tables):
    stored = tables["payments"].filter("order_id = 'O000899'").first()
    assert stored["subtotal"] == Decimal("18710.40")
