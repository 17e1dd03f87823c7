"""Queries over changing, summarised and compared tables; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import numeric
from tillroll.operators import relations, summaries
from tillroll.plans.registry import Registry
from tillroll.plans.sql import with_star
from tillroll.session import materialise, scratch_path
from tillroll.sources.changes import MONTH, History, MonthStore
from tillroll.sources.wholesale import Wholesale

QUERIES = Registry()

# Fixed values of the example batches, the same in the queries and their SQL.
FIRST_END, SECOND_END = "1998-01-01", "2000-01-01"
BATCH_DAYS = ("2001-09-01", "2001-10-01", "2001-11-01")
BUCKETS = 16


def _parts(w: Wholesale, *columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The orders placed before the first end, from there to the second, and after it."""
    orders = w.orders("order_id", "order_date", *columns)
    first, second = F.lit(FIRST_END).cast("date"), F.lit(SECOND_END).cast("date")
    placed = F.col("order_date")
    return (
        orders.filter(placed < first),
        orders.filter((placed >= first) & (placed < second)),
        orders.filter(placed >= second),
    )


# --- stores that take changes ------------------------------------------------------------------


@QUERIES.query(
    with_star(
        f"""SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, order_status,
               strftime(date_trunc('month', order_date), '%Y-%m-%d') AS month
        FROM (SELECT order_id, order_status,
                     CASE WHEN order_date < DATE '{FIRST_END}' AND order_id % 11 = 0
                          THEN CAST(order_date + 40 AS DATE) ELSE order_date END AS order_date,
                     order_date AS placed
              FROM star_orders)
        WHERE NOT (placed < DATE '{SECOND_END}' AND order_id % 31 = 0
                   AND NOT (placed < DATE '{FIRST_END}' AND order_id % 11 = 0))"""
    )
)
def order_upserts(w: Wholesale) -> DataFrame:
    """The orders after three batches: placed, moved by 40 days or added, and deleted or added."""
    first, second, third = _parts(w, "order_status")
    store = MonthStore(w.spark, scratch_path(w.spark, "order-months"), "order_id", "order_date", first.schema)
    store.apply(first)
    moved = first.filter("order_id % 11 = 0")
    moved = moved.withColumn("order_date", F.date_add("order_date", 40))
    store.apply(second.unionByName(moved.select(*second.columns)))
    early = first.unionByName(second).filter("order_id % 31 = 0").select("order_id")
    kept = moved.filter("order_id % 31 = 0").select("order_id")
    store.apply(third, early.join(kept, "order_id", "left_anti"))
    return store.table().select("order_id", "order_date", "order_status", MONTH)


@QUERIES.query(
    with_star(
        f"""SELECT order_id, order_status, version, valid_from, valid_to
        FROM (SELECT order_id, state AS order_status,
                     CAST(count(state) OVER (PARTITION BY order_id ORDER BY day) AS BIGINT) AS version,
                     day AS valid_from, lead(day) OVER (PARTITION BY order_id ORDER BY day) AS valid_to
              FROM (SELECT *, state IS DISTINCT FROM
                              lag(state) OVER (PARTITION BY order_id ORDER BY day) AS turned
                    FROM states)
              WHERE turned)
        WHERE order_status IS NOT NULL""",
        f"""placed AS (
            SELECT order_id, order_status, order_date < DATE '{FIRST_END}' AS early,
                   order_date < DATE '{SECOND_END}' AS middle, order_id % 31 = 0 AS dropped
            FROM star_orders)""",
        f"""states AS (
            SELECT order_id, '{BATCH_DAYS[0]}' AS day, CASE WHEN early THEN order_status END AS state
            FROM placed UNION ALL
            SELECT order_id, '{BATCH_DAYS[1]}', CASE WHEN early AND dropped THEN NULL
                WHEN early AND order_id % 7 = 0 THEN 'Returned' WHEN middle THEN order_status END
            FROM placed UNION ALL
            SELECT order_id, '{BATCH_DAYS[2]}', CASE
                WHEN early AND dropped THEN CASE WHEN order_id % 62 = 0 THEN order_status END
                WHEN middle AND order_id % 5 = 0 THEN 'Delivered'
                WHEN early AND order_id % 7 = 0 THEN 'Returned' ELSE order_status END
            FROM placed)""",
    )
)
def order_history(w: Wholesale) -> DataFrame:
    """Every version of the orders' status after three batches, with orders dropped and back."""
    first, second, third = (part.drop("order_date") for part in _parts(w, "order_status"))
    history = History(
        w.spark, scratch_path(w.spark, "order-history"), "order_id", first.schema, BUCKETS
    )
    days = [F.lit(d).cast("date") for d in BATCH_DAYS]
    history.apply(first, days[0], 0)
    dropped = first.filter("order_id % 31 = 0")
    returned = first.filter("order_id % 7 = 0 AND order_id % 31 <> 0")
    returned = returned.withColumn("order_status", F.lit(numeric.RETURNED))
    history.apply(second.unionByName(returned), days[1], 1, dropped.select("order_id"))
    delivered = first.filter("order_id % 31 <> 0").unionByName(second).filter("order_id % 5 = 0")
    delivered = delivered.withColumn("order_status", F.lit(numeric.DELIVERED))
    back = dropped.filter("order_id % 62 = 0")
    history.apply(third.unionByName(delivered).unionByName(back), days[2], 2)
    return history.table().select("order_id", "order_status", "version", "valid_from", "valid_to")


# --- summaries ---------------------------------------------------------------------------------

_PAID = """paid AS (
    SELECT customer_id, order_date, grand_total FROM star_orders JOIN star_payments USING (order_id))"""
_QUARTER = "strftime(date_trunc('quarter', order_date), '%Y-%m-%d')"


@QUERIES.query(
    with_star(
        f"""SELECT {_QUARTER} AS quarter, count(*) AS orders,
                   count(DISTINCT customer_id) AS customers, TRUE AS customers_near,
                   TRUE AS median_near
            FROM paid GROUP BY 1""",
        _PAID,
    )
)
def quarter_sketches(w: Wholesale) -> DataFrame:
    """Different customers and the median order by quarter, from sketches stored by month, held
    against exact counts: within four standard errors, and within 4 % of the ranks."""
    paid = w.orders("order_id", "customer_id", "order_date").join(
        w.payments("order_id", "grand_total"), "order_id"
    )
    paid = paid.withColumn("month", F.trunc("order_date", "MM"))
    stored = materialise(summaries.sketched(paid, "month", "customer_id", "grand_total"), "sketches")
    quarters = summaries.merged(stored, F.date_trunc("quarter", "month").cast("date"), "quarter")
    estimates = quarters.select(
        "quarter",
        F.col("rows").alias("orders"),
        summaries.distinct_estimate().alias("estimate"),
        summaries.quantile_estimate(0.5).alias("median"),
    )
    exact = paid.withColumn("quarter", F.date_trunc("quarter", "order_date").cast("date"))
    amount = F.col("grand_total").cast("double")
    exact = (
        exact.join(estimates, "quarter")
        .groupBy("quarter", "orders", "estimate")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            (F.count_if(amount < F.col("median")) / F.count("*")).alias("below"),
            (F.count_if(amount <= F.col("median")) / F.count("*")).alias("up_to"),
        )
    )
    error = 4 * 1.04 / 2 ** (summaries.LOG_BUCKETS / 2)
    return exact.select(
        "quarter",
        "orders",
        "customers",
        (F.abs(F.col("estimate") - F.col("customers")) <= error * F.col("customers")).alias(
            "customers_near"
        ),
        ((F.col("below") <= 0.54) & (F.col("up_to") >= 0.46)).alias("median_near"),
    )


@QUERIES.query(
    with_star(
        """SELECT ship_state, category, year, CAST(GROUPING(ship_state) AS BIGINT) AS all_ship_state,
                  CAST(GROUPING(category) AS BIGINT) AS all_category,
                  CAST(GROUPING(year) AS BIGINT) AS all_year,
                  count(DISTINCT order_id) AS orders, CAST(sum(amount) AS DOUBLE) AS revenue
           FROM sold GROUP BY CUBE (ship_state, category, year)""",
        """sold AS (
            SELECT order_id, ship_state, category, year(order_date) AS year,
                   quantity * unit_price AS amount
            FROM star_items JOIN star_orders USING (order_id) JOIN star_products USING (product_id))""",
    )
)
def sales_cube(w: Wholesale) -> DataFrame:
    """Orders and revenue by region, category and year, on all levels."""
    return summaries.sales_cube(
        w.orders("order_id", "order_date", "ship_state"),
        w.order_items("order_id", "product_id", "quantity", "unit_price"),
        w.products("product_id", "category"),
    )


# --- comparisons, hierarchies, conditions ------------------------------------------------------

_SECOND_LOAD = """
    SELECT order_id, channel, CASE WHEN order_id % 13 = 0 THEN NULL ELSE order_status END
           AS order_status, CASE WHEN order_id % 26 = 0 THEN order_date + {days} ELSE order_date END
           AS order_date
    FROM {orders} WHERE order_id % 17 <> 0
    UNION ALL
    SELECT order_id, channel, order_status, order_date FROM {orders} WHERE order_id % 19 = 0"""


@QUERIES.query(
    with_star(
        """SELECT coalesce(a.order_id, b.order_id) AS order_id, coalesce(a.n, 0) AS only_first,
                  coalesce(b.n, 0) AS only_second,
                  CASE WHEN a.n = 1 AND b.n = 1 THEN concat_ws(',',
                      CASE WHEN a.channel IS DISTINCT FROM b.channel THEN 'channel' END,
                      CASE WHEN a.order_status IS DISTINCT FROM b.order_status THEN 'order_status' END,
                      CASE WHEN a.order_date IS DISTINCT FROM b.order_date THEN 'order_date' END)
                  END AS changed
           FROM (SELECT order_id, count(*) AS n, min(channel) AS channel,
                        min(order_status) AS order_status, min(order_date) AS order_date
                 FROM only_a GROUP BY order_id) a
           FULL JOIN (SELECT order_id, count(*) AS n, min(channel) AS channel,
                             min(order_status) AS order_status, min(order_date) AS order_date
                      FROM only_b GROUP BY order_id) b USING (order_id)""",
        "first_load AS (SELECT order_id, channel, order_status, order_date FROM star_orders)",
        "second_load AS ("
        + _SECOND_LOAD.format(days="CAST(1 AS INTEGER)", orders="star_orders")
        + ")",
        "only_a AS (SELECT * FROM first_load EXCEPT ALL SELECT * FROM second_load)",
        "only_b AS (SELECT * FROM second_load EXCEPT ALL SELECT * FROM first_load)",
    )
)
def load_differences(w: Wholesale) -> DataFrame:
    """Orders that two loads hold differently, with the columns that changed."""
    orders = materialise(w.orders("order_id", "channel", "order_status", "order_date"), "first-load")
    second = w.spark.sql(_SECOND_LOAD.replace("{days}", "1"), orders=orders)
    return relations.reconciled(orders, second, "order_id")


@QUERIES.query(
    """WITH RECURSIVE edges AS (
            SELECT 'region ' || r_regionkey AS node, NULL AS parent FROM region UNION ALL
            SELECT 'nation ' || n_nationkey, 'region ' || n_regionkey FROM nation UNION ALL
            SELECT 'customer ' || c_custkey, 'nation ' || c_nationkey FROM customer),
        above AS (
            SELECT node, node AS ancestor FROM edges UNION ALL
            SELECT above.node, edges.parent FROM above JOIN edges ON edges.node = above.ancestor
            WHERE edges.parent IS NOT NULL)
        SELECT ancestor AS node, CAST(sum(orders) AS BIGINT) AS orders, sum(cents) / 100.0 AS revenue
        FROM above JOIN (
            SELECT 'customer ' || o_custkey AS node, count(*) AS orders,
                   sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
            FROM orders GROUP BY 1) USING (node)
        GROUP BY ancestor"""
)
def region_rollup(w: Wholesale) -> DataFrame:
    """Orders and revenue of every customer, nation and region, summed up the hierarchy."""

    def level(table: str, name: str, key: str, above: str | None) -> DataFrame:
        parent = F.lit(None).cast("string")
        if above:
            kind, column = above.split(":")
            parent = F.concat(F.lit(f"{kind} "), F.col(column))
        return w.source(table).select(
            F.concat(F.lit(f"{name} "), F.col(key)).alias("node"), parent.alias("parent")
        )

    edges = (
        level("region", "region", "r_regionkey", None)
        .unionAll(level("nation", "nation", "n_nationkey", "region:n_regionkey"))
        .unionAll(level("customer", "customer", "c_custkey", "nation:c_nationkey"))
    )
    amounts = w.source("orders").select(
        F.concat(F.lit("customer "), F.col("o_custkey")).alias("node"),
        F.lit(1).alias("orders"),
        F.expr("CAST(CAST(rint(o_totalprice * 100) AS BIGINT) AS DECIMAL(18,0)) * 0.01BD").alias(
            "revenue"
        ),
    )
    return relations.rolled_up(edges, amounts, ["orders", "revenue"])


@QUERIES.query(
    with_star(
        """SELECT customer_id, CAST(grand_total AS DOUBLE) AS last_amount,
                  (SELECT count(*) FROM bought i WHERE i.customer_id = o.customer_id) AS n
           FROM bought o
           WHERE NOT EXISTS (SELECT 1 FROM bought i WHERE i.customer_id = o.customer_id
                             AND (i.order_date, i.order_id) > (o.order_date, o.order_id))
             AND grand_total > (SELECT sum(grand_total) / count(*)::DOUBLE FROM bought i
                                WHERE i.customer_id = o.customer_id)""",
        """bought AS (
            SELECT customer_id, order_id, order_date, grand_total
            FROM star_orders JOIN star_payments USING (order_id))""",
    )
)
def above_own_mean(w: Wholesale) -> DataFrame:
    """Customers whose last order was above their own average."""
    bought = w.orders("order_id", "customer_id", "order_date").join(
        w.payments("order_id", "grand_total"), "order_id"
    )
    return relations.last_above_own_mean(
        bought, "customer_id", ["order_date", "order_id"], "grand_total"
    )


@QUERIES.query(
    with_star(
        """SELECT customer_id, segment FROM star_customers c
           WHERE NOT EXISTS (SELECT 1 FROM star_orders o WHERE o.customer_id = c.customer_id
                             AND o.order_status = 'Returned')
             AND customer_id NOT IN (SELECT customer_id FROM star_orders
                                     WHERE order_status = 'Cancelled' AND customer_id IS NOT NULL)"""
    )
)
def never_returned(w: Wholesale) -> DataFrame:
    """Customers without a returned or cancelled order."""
    customers = w.customers("customer_id", "segment")
    returned = w.orders("customer_id", "order_status", statuses=(numeric.RETURNED,))
    cancelled = w.orders("customer_id", "order_status", statuses=(numeric.CANCELLED,))
    kept = relations.without(customers, returned, "customer_id")
    return relations.without(
        kept, cancelled.filter(F.col("customer_id").isNotNull()), "customer_id", null_aware=True
    )


# What a careless sender makes of some props, as SQL that both engines take.
_SENT = """CASE WHEN event_id % 101 = 0 THEN substr(props, 1, 5)
                WHEN event_id % 103 = 0 THEN '[1, 2]'
                WHEN event_id % 107 = 0 THEN NULL
                WHEN event_id % 10 = 0 THEN concat('{"k": ', event_id % 7, ', "tag": "t', event_id % 3, '"}')
                ELSE props END"""
_MISFIT = "event_id % 101 = 0 OR event_id % 103 = 0"


@QUERIES.query(
    f"""SELECT event_id, CAST(json_extract_string(sent, '$.k') AS BIGINT) AS k,
               json_extract_string(sent, '$.tag') AS tag
        FROM (SELECT event_id, {_SENT} AS sent FROM events) WHERE NOT ({_MISFIT})"""
)
def event_fields(w: Wholesale) -> DataFrame:
    """The events' properties as typed columns."""
    sent = w.source("events").select("event_id", F.expr(_SENT).alias("sent"))
    return relations.shredded(sent, "sent", ["event_id"])[0]


@QUERIES.query(
    f"""SELECT CASE WHEN event_id % 101 = 0 THEN 'cut off' ELSE 'no object' END AS reason,
               count(*) AS events FROM events WHERE {_MISFIT} GROUP BY 1"""
)
def event_misfits(w: Wholesale) -> DataFrame:
    """Properties that are no JSON object, set apart and counted."""
    sent = w.source("events").select("event_id", F.expr(_SENT).alias("sent"))
    _, misfits = relations.shredded(sent, "sent", ["event_id"])
    reason = F.when(relations.json_fields(F.col("sent")).isNull(), "cut off").otherwise("no object")
    return misfits.groupBy(reason.alias("reason")).agg(F.count("*").alias("events"))
