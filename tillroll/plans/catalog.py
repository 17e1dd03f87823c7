"""Every analysis by name, over a folder of wholesale-style Parquet tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import numeric
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
from tillroll.plans import stored, timed
from tillroll.plans.load import load_star
from tillroll.session import materialise, on_clear, scratch_path, tune
from tillroll.sources import files
from tillroll.sources.schemas import TABLES, Star
from tillroll.sources.wholesale import AS_OF, CASH_SEGMENT, Wholesale

Query = Callable[[SparkSession, str], DataFrame]

SQL_PULL = """
    SELECT o.channel, count(*) AS orders, round(sum(p.grand_total), 2) AS revenue
    FROM {orders} o JOIN {payments} p USING (order_id)
    WHERE o.order_date >= :since AND p.payment_status = :payment_status
    GROUP BY o.channel
"""
SINCE = datetime.date(1998, 1, 1)
PARAM_RANGE = (datetime.date(1996, 1, 1), datetime.date(1998, 12, 31))
PARAM_CHANNEL = "1-URGENT"
PARAM_CATEGORY = "ECONOMY"
PREVIEW_ROWS = 5

_REGISTRY: dict[str, Callable[[Wholesale], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Output types any SQL engine can reproduce: decimals as doubles, dates as ISO text, whole
    numbers as bigint."""

    def plain(f: T.StructField):
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(f.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(f.dataType, T.IntegralType):
            value = value.cast("bigint")
        return value.alias(f.name)

    return df.select(*[plain(f) for f in df.schema])


def queries() -> dict[str, Query]:
    def bound(build: Callable[[Wholesale], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(Wholesale(tune(spark), folder)))

        return run

    builders = _REGISTRY | timed.QUERIES.builders | stored.QUERIES.builders
    return {name: bound(build) for name, build in builders.items()}


# Tables that several queries read, stored once for each application and state of a folder.
_STORED: dict[tuple, DataFrame] = {}


def _stored(w: Wholesale, name: str, build: Callable[[Wholesale], DataFrame]) -> DataFrame:
    key = (w.spark.sparkContext.applicationId, w.folder, w.version(), name)
    if key not in _STORED:
        _STORED[key] = build(w)
    return _STORED[key]


@on_clear
def forget_stored() -> None:
    """Build stored tables anew when they are next needed, as after their folder was cleared."""
    _STORED.clear()


def _query(build: Callable[[Wholesale], DataFrame]) -> Callable[[Wholesale], DataFrame]:
    _REGISTRY[build.__name__] = build
    return build


# --- sources and sinks -------------------------------------------------------------------------


@_query
def src_schemas(w: Wholesale) -> DataFrame:
    return quality.column_profile(w.tables())


@_query
def src_csv(w: Wholesale) -> DataFrame:
    orders = w.orders()
    path = scratch_path(orders.sparkSession, "orders-csv")
    files.write_csv(orders, path)
    return files.accepted(files.read_csv(orders.sparkSession, path, "orders"))


@_query
def src_load(w: Wholesale) -> DataFrame:
    """Rows and quarantined lines of each table after a load from CSV; some lines do not fit."""
    spark = w.spark
    root = scratch_path(spark, "star-csv")
    for name, table in w.tables().items():
        files.write_csv(table, f"{root}/{name}", "gzip")
    misfits = w.orders("order_id").filter(F.col("order_id") % 97 == 0)
    misfits.select(
        F.lit("X").alias("order_id"),
        F.lit("Y").alias("customer_id"),
        F.concat(F.lit("day "), F.col("order_id").cast("string")).alias("order_date"),
    ).write.option("header", True).csv(f"{root}/misfits")
    paths = {name: f"{root}/{name}" for name in TABLES}
    loaded = load_star(
        spark,
        paths | {"orders": [f"{root}/orders", f"{root}/misfits"]},
        scratch_path(spark, "star"),
    )
    lost = [
        lines.agg(F.count("*").alias("rejected_lines")).select(
            F.lit(name).alias("name"), "rejected_lines"
        )
        for name, lines in loaded.rejected.items()
    ]
    per_table = lost[0]
    for part in lost[1:]:
        per_table = per_table.unionAll(part)
    counted = loaded.row_counts
    return counted.join(per_table, F.col("table_name") == F.col("name")).drop("name")


@_query
def src_csv_multi_line(w: Wholesale) -> DataFrame:
    """Names with line breaks, written as CSV and read back."""
    broken = w.customers().withColumn(
        "full_name", F.concat_ws("\n", "full_name", F.lit('said "hi", twice'))
    )
    path = scratch_path(w.spark, "customers-csv")
    files.write_csv(broken, path)
    loaded = files.accepted(files.read_csv(w.spark, path, "customers", multi_line=True))
    return loaded.select("customer_id", "full_name", "segment")


@_query
def src_rows(w: Wholesale) -> DataFrame:
    paid = w.payments("order_id", "payment_method", "grand_total", "payment_status")
    total = F.col("grand_total").cast("double")
    loose = paid.select(
        "order_id",
        "payment_method",
        (total / 1.18).alias("subtotal"),
        (total - total / 1.18).alias("tax_amount"),
        F.lit(0.0).alias("shipping_fee"),
        total.alias("grand_total"),
        "payment_status",
    )
    return files.load_rows(paid.sparkSession, loose, "payments")


@_query
def src_sql_pull(w: Wholesale) -> DataFrame:
    tables = {
        "orders": w.orders("order_id", "order_date", "channel"),
        "payments": w.payments("order_id", "grand_total", "payment_status"),
    }
    spark = tables["orders"].sparkSession
    return files.query(spark, SQL_PULL, tables, since=SINCE, payment_status=numeric.PAID)


@_query
def src_parse_dates(w: Wholesale) -> DataFrame:
    dated = w.orders("order_id", "customer_id", "order_date", "delivered_date").join(
        w.customers("customer_id", "signup_date"), "customer_id"
    )
    text = dated.select(
        "order_id",
        F.col("order_date").cast("string").alias("order_date"),
        # what a loosely kept file may say instead of leaving the field empty
        F.coalesce(F.col("delivered_date").cast("string"), F.lit("not yet")).alias(
            "delivered_date"
        ),
        F.concat(F.lit(" "), F.col("signup_date").cast("string")).alias("signup_date"),
    ).withColumn(
        "order_date",
        F.when(F.col("order_id") % 3 == 0, F.concat("order_date", F.lit(" 23:59:00")))
        .when(F.col("order_id") % 7 == 0, F.lit("2024-13-45"))
        .otherwise(F.col("order_date")),
    )
    days = files.parse_dates(text, ["order_date", "delivered_date", "signup_date"], misfits_as="m")
    return days.withColumn("misfits", F.array_join("m", ",")).drop("m")


@_query
def snk_csv(w: Wholesale) -> DataFrame:
    scored = _segmented(w)
    spark = scored.sparkSession
    path = scratch_path(spark, "rfm-csv")
    files.write_csv(scored, path)
    return spark.read.schema(scored.schema).option("header", True).csv(path)


@_query
def row_counts(w: Wholesale) -> DataFrame:
    return quality.row_counts(
        {
            "customers": w.customers("customer_id"),
            "products": w.products("product_id"),
            "orders": w.orders("order_id"),
            "order_items": w.order_items("order_id"),
            "payments": w.payments("order_id"),
        }
    )


# --- data quality ------------------------------------------------------------------------------


def _keyed(w: Wholesale) -> dict[str, DataFrame]:
    """The five tables, with key, unique and required columns only."""
    kept = {
        name: dict.fromkeys(
            (*spec.not_null, *spec.unique, *(column for column, _ in spec.references))
        )
        for name, spec in TABLES.items()
    }
    return {name: getattr(w, name)(*columns) for name, columns in kept.items()}


@_query
def dq_primary_key(w: Wholesale) -> DataFrame:
    return quality.primary_keys(_keyed(w))


@_query
def dq_unique(w: Wholesale) -> DataFrame:
    tables = _keyed(w)
    return quality.unique_columns(tables).unionByName(
        quality.repeated_keys(tables, {"products": ("product_name",)})
    )


@_query
def dq_not_null(w: Wholesale) -> DataFrame:
    return quality.not_null(_keyed(w))


@_query
def dq_foreign_key(w: Wholesale) -> DataFrame:
    declared = [(t, c, parent) for t, spec in TABLES.items() for c, parent in spec.references]
    return quality.foreign_keys(_keyed(w), [*declared, ("orders", "order_id", "order_items")])


@_query
def dq_default(w: Wholesale) -> DataFrame:
    return quality.default_usage(
        {"customers": w.customers("is_active"), "products": w.products("is_discontinued")}
    )


@_query
def q01_dup_emails(w: Wholesale) -> DataFrame:
    return quality.duplicates(w.customers("email"), ["email"])


@_query
def q02_null_audit(w: Wholesale) -> DataFrame:
    return quality.status_null_audit(w.orders("order_status", "delivered_date"))


@_query
def null_summary(w: Wholesale) -> DataFrame:
    return facts.fact_null_summary(w.star())


@_query
def describe_metrics(w: Wholesale) -> DataFrame:
    return rfm.describe_metrics(_base(w))


@_query
def preview(w: Wholesale) -> DataFrame:
    return quality.preview(
        w.orders("order_id"), PREVIEW_ROWS, ["order_id"], lambda ids: w.orders(only=ids)
    )


# --- distribution and revenue ------------------------------------------------------------------


def _revenue_tables(
    w: Wholesale, *order_columns: str, statuses: tuple[str, ...] = revenue.REALISED
) -> tuple[DataFrame, DataFrame]:
    return (
        w.orders("order_id", "order_status", *order_columns, statuses=statuses),
        w.payments("order_id", "grand_total", "payment_status", paid_only=True),
    )


@_query
def q03_status_dist(w: Wholesale) -> DataFrame:
    return revenue.status_distribution(w.orders("order_status"))


def _fact_keys(w: Wholesale, *payment_columns: str, paid_only: bool = False) -> list[DataFrame]:
    """Payments, lines, products and customers, with the keys that make an order a fact."""
    return [
        w.payments("order_id", *payment_columns, paid_only=paid_only),
        w.order_items("order_id", "product_id"),
        w.products("product_id"),
        w.customers("customer_id"),
    ]


@_query
def status_counts_distinct(w: Wholesale) -> DataFrame:
    return revenue.status_counts(
        w.orders("order_id", "customer_id", "order_status"), *_fact_keys(w)
    )


@_query
def q04_total_revenue(w: Wholesale) -> DataFrame:
    return revenue.total_revenue(*_revenue_tables(w))


@_query
def q05_monthly_revenue(w: Wholesale) -> DataFrame:
    return revenue.monthly_revenue(*_revenue_tables(w, "order_date"))


@_query
def q06_channel_month(w: Wholesale) -> DataFrame:
    return revenue.channel_revenue(*_revenue_tables(w, "order_date", "channel"))


@_query
def daily_revenue(w: Wholesale) -> DataFrame:
    return revenue.daily_revenue(*_revenue_tables(w, "order_date", statuses=revenue.BILLED))


@_query
def monthly_revenue_chart(w: Wholesale) -> DataFrame:
    return revenue.monthly_revenue_chart(
        w.orders(
            "order_id", "customer_id", "order_date", "order_status", statuses=revenue.BILLED
        ),
        *_fact_keys(w, "grand_total", "payment_status", paid_only=True),
    )


@_query
def q04_delivered_revenue(w: Wholesale) -> DataFrame:
    orders = w.orders("order_id", "order_status", statuses=revenue.REALISED)
    payments = w.payments("order_id", "grand_total")
    return revenue.total_revenue(orders, payments, payment_statuses=None)


@_query
def q05_delivered_by_month(w: Wholesale) -> DataFrame:
    orders = w.orders("order_id", "order_status", "order_date", statuses=revenue.REALISED)
    payments = w.payments("order_id", "grand_total")
    return revenue.monthly_revenue(orders, payments, payment_statuses=None)


# --- customers ---------------------------------------------------------------------------------


@_query
def q07_top_customers(w: Wholesale) -> DataFrame:
    return customers.top_customers(
        w.customers("customer_id", "full_name", "city", "segment"),
        *_revenue_tables(w, "customer_id"),
    )


@_query
def q08_repeat_rate(w: Wholesale) -> DataFrame:
    return customers.repeat_rate(
        w.orders("order_id", "customer_id", "order_status", statuses=revenue.REALISED)
    )


@_query
def q09_cohort_retention(w: Wholesale) -> DataFrame:
    return customers.cohort_retention(
        w.customers("customer_id", "signup_date"),
        w.orders("customer_id", "order_date", "order_status", statuses=revenue.REALISED),
    )


@_query
def q17_customer_history(w: Wholesale) -> DataFrame:
    return customers.customer_history(
        w.customers("customer_id", "full_name"),
        *_revenue_tables(w, "customer_id", "order_date"),
        as_of=AS_OF,
    )


@_query
def q17b_running_spend(w: Wholesale) -> DataFrame:
    return customers.running_spend(
        w.customers("customer_id"), *_revenue_tables(w, "customer_id", "order_date")
    )


def _base(w: Wholesale) -> DataFrame:
    def build(w: Wholesale) -> DataFrame:
        orders = ("order_id", "customer_id", "order_date", "order_status")
        return rfm.rfm_base(
            w.orders(*orders, statuses=revenue.REALISED),
            *_fact_keys(w, "grand_total", "payment_status", paid_only=True),
        )

    return _stored(w, "rfm-base", build)


def _segmented(w: Wholesale) -> DataFrame:
    def build(w: Wholesale) -> DataFrame:
        return materialise(rfm.rfm_segment(rfm.rfm_scores(_base(w))), "rfm-segmented")

    return _stored(w, "rfm-segmented", build)


@_query
def rfm_base(w: Wholesale) -> DataFrame:
    return _base(w)


@_query
def rfm_scores(w: Wholesale) -> DataFrame:
    return _segmented(w).select(
        "customer_id", "R_score", "F_score", "M_score", "RFM_score"
    )


@_query
def rfm_segment(w: Wholesale) -> DataFrame:
    return _segmented(w).select("customer_id", "segment")


@_query
def rfm_segment_summary(w: Wholesale) -> DataFrame:
    return rfm.rfm_segment_summary(_segmented(w))


@_query
def rfm_segment_counts(w: Wholesale) -> DataFrame:
    return rfm.rfm_segment_counts(_segmented(w))


# --- products, categories, operations ----------------------------------------------------------


def _sales_tables(
    w: Wholesale,
    line_columns: tuple[str, ...] = ("quantity", "unit_price"),
    product_columns: tuple[str, ...] = ("category",),
    order_columns: tuple[str, ...] = (),
    statuses: tuple[str, ...] = revenue.REALISED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        w.orders("order_id", "order_status", *order_columns, statuses=statuses),
        w.order_items("order_id", "product_id", *line_columns),
        w.products("product_id", *product_columns),
    )


@_query
def q10a_category_revenue(w: Wholesale) -> DataFrame:
    return products.category_revenue(*_sales_tables(w))


@_query
def q10b_category_quantity(w: Wholesale) -> DataFrame:
    return products.category_quantity(*_sales_tables(w))


@_query
def top_categories_chart(w: Wholesale) -> DataFrame:
    return products.top_categories_chart(
        w.orders("order_id", "customer_id", "order_status", statuses=revenue.REALISED),
        w.payments("order_id"),
        w.order_items("order_id", "product_id", "quantity", "unit_price"),
        w.products("product_id", "category"),
        w.customers("customer_id"),
    )


@_query
def q11_discount_impact(w: Wholesale) -> DataFrame:
    return products.discount_impact(
        *_sales_tables(w, ("list_price", "discount_amount"), ("category", "brand"))
    )


@_query
def q12_top_profit(w: Wholesale) -> DataFrame:
    return products.top_profit(
        *_sales_tables(
            w, product_columns=("product_name", "category", "brand", "unit_cost")
        )
    )


@_query
def q13_delivery_days(w: Wholesale) -> DataFrame:
    return operations.delivery_time(
        w.orders(
            "order_status",
            "order_date",
            "delivered_date",
            "ship_carrier",
            statuses=revenue.REALISED,
        )
    )


@_query
def q14a_return_carrier(w: Wholesale) -> DataFrame:
    return operations.return_rate_by_carrier(
        w.orders("order_status", "ship_carrier", statuses=revenue.BILLED)
    )


@_query
def q14b_return_category(w: Wholesale) -> DataFrame:
    return operations.return_rate_by_category(
        *_sales_tables(w, (), statuses=revenue.BILLED)
    )


@_query
def q14b_fixed(w: Wholesale) -> DataFrame:
    return operations.return_rate_by_category_orders(
        *_sales_tables(w, (), statuses=revenue.BILLED)
    )


@_query
def return_rate_carrier_chart(w: Wholesale) -> DataFrame:
    return operations.return_rate_carrier_chart(
        w.orders("order_id", "customer_id", "order_status", "ship_carrier"), *_fact_keys(w)
    )


@_query
def q15_cancel_by_payment(w: Wholesale) -> DataFrame:
    return operations.cancellation_by_payment(w.orders("order_status", "payment_method"))


@_query
def q15b_cod_vs_prepaid(w: Wholesale) -> DataFrame:
    return operations.cancellation_cod_prepaid(
        w.orders("order_status", "payment_method"), cod=CASH_SEGMENT
    )


@_query
def q16_category_rank(w: Wholesale) -> DataFrame:
    return products.category_rank(*_sales_tables(w, order_columns=("order_date",)))


@_query
def q18_basket_pairs(w: Wholesale) -> DataFrame:
    # brands make 300 pairs, so that the limit of 20 matters
    return basket.basket_pairs(*_sales_tables(w, (), ("brand",)), column="brand")


@_query
def q18_category_pairs(w: Wholesale) -> DataFrame:
    return basket.basket_pairs(*_sales_tables(w, ()), min_orders=2)


def _range_star(w: Wholesale) -> Star:
    star = Star(
        customers=w.customers("customer_id"),
        products=w.products("product_id", "category"),
        orders=w.orders("order_id", "order_date", "order_status", "ship_carrier", "channel"),
        order_items=w.order_items("order_id", "product_id", "quantity", "unit_price"),
        payments=w.payments("order_id", "grand_total", "payment_status"),
    )
    return facts.in_range(star, *PARAM_RANGE, PARAM_CHANNEL)


@_query
def range_category_revenue(w: Wholesale) -> DataFrame:
    star = _range_star(w)
    return products.category_revenue(star.orders, star.order_items, star.products)


@_query
def range_monthly_revenue(w: Wholesale) -> DataFrame:
    star = _range_star(w)
    return revenue.monthly_revenue(star.orders, star.payments)


@_query
def range_carrier_returns(w: Wholesale) -> DataFrame:
    return operations.return_rate_by_carrier(_range_star(w).orders)


# --- fact table --------------------------------------------------------------------------------


@_query
def fact_table(w: Wholesale) -> DataFrame:
    return facts.fact_table(w.star())


@_query
def fact_derived(w: Wholesale) -> DataFrame:
    return facts.derived(facts.fact_table(w.star()))


@_query
def fact_sample(w: Wholesale) -> DataFrame:
    return facts.fact_sample(w.star())


@_query
def line_revenue(w: Wholesale) -> DataFrame:
    lines = w.order_items("order_id", "line_no", "product_id", "quantity", "unit_price")
    return lines.select(
        "order_id", "line_no", "product_id", numeric.line_revenue().alias("revenue")
    )


@_query
def line_profit(w: Wholesale) -> DataFrame:
    lines = w.order_items("order_id", "line_no", "product_id", "quantity", "unit_price")
    return lines.join(w.products("product_id", "unit_cost"), "product_id").select(
        "order_id", "line_no", "product_id", numeric.line_profit().alias("profit")
    )


@_query
def line_discount_pct(w: Wholesale) -> DataFrame:
    lines = w.order_items("order_id", "line_no", "product_id", "list_price", "discount_amount")
    return lines.select(
        "order_id", "line_no", "product_id", numeric.line_discount_pct().alias("discount_pct")
    )


@_query
def delivery_days(w: Wholesale) -> DataFrame:
    orders = w.orders("order_id", "order_date", "delivered_date")
    return orders.select("order_id", numeric.delivery_days().alias("delivery_days"))


@_query
def order_month(w: Wholesale) -> DataFrame:
    orders = w.orders("order_id", "order_date")
    return orders.select("order_id", numeric.month_start().alias("order_month"))


@_query
def month_stored_query(w: Wholesale) -> DataFrame:
    """The same question over orders, lines and payments stored by month."""
    orders = w.orders().withColumn(files.ORDER_MONTH, F.trunc("order_date", "MM"))

    def stored(rows: DataFrame, month: str, name: str) -> DataFrame:
        return files.write_by_months(rows, scratch_path(w.spark, name), month)

    orders = stored(orders, files.ORDER_MONTH, "orders-by-month")
    star = Star(
        customers=w.customers(),
        products=w.products(),
        orders=orders,
        order_items=stored(
            files.with_placed_month(w.order_items(), orders), files.PLACED_MONTH, "lines-by-month"
        ),
        payments=stored(
            files.with_placed_month(w.payments(), orders), files.PLACED_MONTH, "payments-by-month"
        ),
    )
    return facts.fact_query(star, *PARAM_RANGE, PARAM_CHANNEL, PARAM_CATEGORY)


@_query
def param_query(w: Wholesale) -> DataFrame:
    # delivery and signup dates are looked up for the chosen orders and their buyers only
    chosen = facts.chosen_orders(
        w.orders("order_id", "customer_id", "order_date", "channel"), *PARAM_RANGE, PARAM_CHANNEL
    )
    star = Star(
        customers=w.customers(only=chosen.select("customer_id").distinct()),
        products=w.products(),
        orders=w.orders(only=chosen.select("order_id").distinct()),
        order_items=w.order_items(),
        payments=w.payments(),
    )
    return facts.fact_query(star, *PARAM_RANGE, PARAM_CHANNEL, PARAM_CATEGORY)
