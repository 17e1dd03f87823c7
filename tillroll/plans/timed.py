"""Queries along time, streamed and stored, over the wholesale-style tables; each with its SQL.

Event streams arrive in ARRIVALS batches by event id; some events come one batch later than their
neighbours.  Every arrival is landed and then processed from the checkpoint of the last run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import temporal
from tillroll.plans.registry import Registry
from tillroll.plans.sql import day, with_star
from tillroll.session import scratch_path
from tillroll.sources.wholesale import ITEM_COLUMNS, Wholesale
from tillroll.streaming.landing import Landing, Sink
from tillroll.streaming.windows import session_totals, window_totals, within

# Fixed values of the example streams, the same in the queries and their SQL.
ARRIVALS = 3
DELAYED = "event_id % 37 = 0"
DELAY = "12 HOURS"
GAP_HOURS = 6
LAST_YEAR, FIRST_YEAR, YEARS_EACH = 2001, 1995, 3
SHIPPED_WITHIN = 30

QUERIES = Registry()

SECONDS, MICROS = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS"

def _totals() -> dict[str, Column]:
    return {
        "events": F.count("*"),
        "cents": F.sum(F.expr("CAST(rint(value * 100) AS BIGINT)")),
    }


def _text(column: str, pattern: str = SECONDS) -> Column:
    return F.date_format(column, pattern).alias(column)


def _events(w: Wholesale) -> DataFrame:
    return w.source("events").withColumn("ts", F.col("ts").cast("timestamp"))


def _arrivals(w: Wholesale) -> tuple[Landing, list[DataFrame]]:
    """An empty landing for the events, and the rows of each arrival."""
    events = _events(w)
    last = events.agg(F.max("event_id")).first()[0]
    number = F.expr(
        f"least(event_id * {ARRIVALS} div {(last or 0) + 1} + IF({DELAYED}, 1, 0), {ARRIVALS})"
    )
    landing = Landing(w.spark, scratch_path(w.spark, "landing"), "ts", DELAY)
    return landing, [events.filter(number == n) for n in range(ARRIVALS + 1)]


def _streamed(w: Wholesale, build: Callable[[Landing], DataFrame]) -> DataFrame:
    """The table that a stream over the events has filled after the last arrival."""
    landing, arrivals = _arrivals(w)
    sink = Sink(w.spark, scratch_path(w.spark, "streamed"))
    for number, rows in enumerate(arrivals):
        landing.add(rows, number)
        stream = build(landing)
        sink.advance(stream)
    return sink.table(stream.schema)


_IN_TIME = f"""arrived AS (
    SELECT *, least(event_id * {ARRIVALS} // ((SELECT max(event_id) FROM events) + 1)
                    + CASE WHEN {DELAYED} THEN 1 ELSE 0 END, {ARRIVALS}) AS arrival
    FROM events),
bounds AS (
    SELECT a.arrival, max(b.ts) - INTERVAL {DELAY} AS late_before
    FROM (SELECT DISTINCT arrival FROM arrived) a
    LEFT JOIN arrived b ON b.arrival < a.arrival GROUP BY a.arrival),
judged AS (
    SELECT arrived.*, coalesce(ts <= late_before, FALSE) AS late
    FROM arrived JOIN bounds USING (arrival)),
in_time AS (SELECT * FROM judged WHERE NOT late),
closing AS (SELECT max(ts) - INTERVAL {DELAY} AS closed FROM in_time)"""

_EVENT_SUMS = """count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents"""


def _window_sql(source: str, start: str, hours: int) -> str:
    return f"""WITH {_IN_TIME},
        placed AS (SELECT {start} AS start, event_type, value FROM {source})
        SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, {_EVENT_SUMS}
        FROM placed WHERE start + INTERVAL {hours} HOUR <= (SELECT closed FROM closing)
        GROUP BY start, event_type"""


@QUERIES.query(_window_sql("in_time", "time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')", 6))
def stream_tumbling_windows(w: Wholesale) -> DataFrame:
    """Events in time by type and six hours, windows closed by the watermark."""
    table = _streamed(
        w,
        lambda landing: window_totals(
            landing.in_time(), "ts", "6 hours", ["event_type"], _totals()
        ),
    )
    return table.select(_text("window_start"), "event_type", "events", "cents")


@QUERIES.query(
    _window_sql(
        "in_time, (SELECT unnest(range(0, 24, 6)) AS back)",
        "time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - back * INTERVAL 1 HOUR",
        24,
    )
)
def stream_sliding_windows(w: Wholesale) -> DataFrame:
    """The same by days that start every six hours."""
    table = _streamed(
        w,
        lambda landing: window_totals(
            landing.in_time(), "ts", "24 hours", ["event_type"], _totals(), slide="6 hours"
        ),
    )
    return table.select(_text("window_start"), "event_type", "events", "cents")


@QUERIES.query(
    f"""WITH {_IN_TIME} SELECT event_id, CAST(arrival AS BIGINT) AS arrival,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM judged WHERE late"""
)
def stream_late_events(w: Wholesale) -> DataFrame:
    """The events that came after the watermark had passed them."""
    table = _streamed(w, lambda landing: landing.late())
    return table.select("event_id", "arrival", _text("ts"))


def _session_sql(source: str, only_closed: str) -> str:
    return f"""marked AS (
            SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                                <= INTERVAL {GAP_HOURS} HOUR THEN 0 ELSE 1 END AS opens
            FROM {source}),
        numbered AS (
            SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked)
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
               strftime(max(ts) + INTERVAL {GAP_HOURS} HOUR, '%Y-%m-%d %H:%M:%S.%f') AS session_end,
               {_EVENT_SUMS}
        FROM numbered GROUP BY user_id, session {only_closed}"""


def _sessions(table: DataFrame) -> DataFrame:
    return table.select(
        "user_id", _text("session_start", MICROS), _text("session_end", MICROS), "events", "cents"
    )


@QUERIES.query(
    f"""WITH {_IN_TIME}, """
    + _session_sql(
        "in_time",
        f"HAVING max(ts) + INTERVAL {GAP_HOURS} HOUR <= (SELECT closed FROM closing)",
    )
)
def stream_sessions(w: Wholesale) -> DataFrame:
    """Users' sessions of events in time, as far as the watermark has closed them."""
    return _sessions(
        _streamed(
            w,
            lambda landing: session_totals(
                landing.in_time(), "ts", f"{GAP_HOURS} hours", ["user_id"], _totals()
            ),
        )
    )


@QUERIES.query("WITH " + _session_sql("events", ""))
def event_sessions(w: Wholesale) -> DataFrame:
    """Users' sessions over all events."""
    return _sessions(
        temporal.sessions(_events(w), ["user_id"], "ts", GAP_HOURS * 3600, _totals())
    )


def _by_years(rows: DataFrame, time: str) -> list[DataFrame]:
    return [
        rows.filter(F.year(time).between(year, year + YEARS_EACH - 1))
        for year in range(FIRST_YEAR, LAST_YEAR + 1, YEARS_EACH)
    ]


def order_shipments(w: Wholesale) -> tuple[DataFrame, Sink]:
    """Orders with their lines shipped within 30 days, as a stream, and its sink."""
    placed = w.source("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("placed")
    )
    shipped = w.source("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
    )
    orders = Landing(w.spark, scratch_path(w.spark, "orders-landing"), "placed", "1 DAY")
    lines = Landing(w.spark, scratch_path(w.spark, "lines-landing"), "shipped", "1 DAY")
    sink = Sink(w.spark, scratch_path(w.spark, "order-shipments"))
    years = zip(_by_years(placed, "placed"), _by_years(shipped, "shipped"), strict=True)
    for number, (some_orders, some_lines) in enumerate(years):
        orders.add(some_orders, number)
        lines.add(some_lines, number)
        stream = within(
            orders.in_time().drop("arrival"),
            lines.in_time().drop("arrival"),
            "order_id",
            "placed",
            "shipped",
            f"{SHIPPED_WITHIN} DAYS",
        )
        sink.advance(stream)
    return sink.table(stream.schema), sink


@QUERIES.query(
    f"""WITH settled AS (
            SELECT o_orderkey AS order_id, o_orderdate AS placed FROM orders
            WHERE CAST(o_orderdate AS DATE) < (
                SELECT least((SELECT max(CAST(o_orderdate AS DATE)) FROM orders),
                             (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem
                              WHERE year(l_shipdate) <= {LAST_YEAR}))
                       - {SHIPPED_WITHIN + 2}))
        SELECT order_id, {day('placed')}, CAST(l_linenumber AS BIGINT) AS line_no,
               strftime(l_shipdate, '%Y-%m-%d') AS shipped
        FROM settled LEFT JOIN lineitem ON l_orderkey = order_id AND l_shipdate >= placed
            AND l_shipdate <= placed + INTERVAL {SHIPPED_WITHIN} DAY
            AND year(l_shipdate) <= {LAST_YEAR}"""
)
def stream_order_shipments(w: Wholesale) -> DataFrame:
    """Settled orders with their shipments within 30 days, or none."""
    table, _ = order_shipments(w)
    last_order = w.source("orders").agg(F.max(F.expr("CAST(o_orderdate AS DATE)"))).first()[0]
    last_line = (
        w.source("lineitem")
        .filter(F.year("l_shipdate") <= LAST_YEAR)
        .agg(F.max(F.expr("CAST(l_shipdate AS DATE)")))
        .first()[0]
    )
    settled = F.date_sub(F.least(F.lit(last_order), F.lit(last_line)), SHIPPED_WITHIN + 2)
    return table.filter(F.to_date("placed") < settled).select(
        "order_id",
        F.to_date("placed").alias("placed"),
        "line_no",
        F.to_date("shipped").alias("shipped"),
    )


@QUERIES.query(
    with_star(
        f"""SELECT order_id, CAST(line_no AS BIGINT) AS line_no, asked.product_id,
                   {day('order_date')}, {day('quoted_on')}, CAST(quoted AS DOUBLE) AS unit_price
            FROM asked ASOF LEFT JOIN quotes
                ON asked.product_id = quotes.product_id AND asked.order_date >= quotes.quoted_on""",
        """asked AS (
            SELECT order_id, line_no, product_id, order_date
            FROM star_items JOIN star_orders USING (order_id))""",
        """quotes AS (
            SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS quoted_on,
                   max(CAST(l_extendedprice AS DECIMAL(10,2))
                       - CAST(round(CAST(l_extendedprice AS DECIMAL(10,2))
                                    * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(10,2)))
                       AS quoted
            FROM lineitem GROUP BY 1, 2)""",
    )
)
def line_price_as_of(w: Wholesale) -> DataFrame:
    """Each order line with the price at which its product was last shipped by the order's day."""
    lines = w.order_items("order_id", "line_no", "product_id").join(
        w.orders("order_id", "order_date"), "order_id"
    )
    quotes = w.source("lineitem").selectExpr(
        f"{ITEM_COLUMNS['product_id']} AS product_id",
        "CAST(l_shipdate AS DATE) AS quoted_on",
        f"{ITEM_COLUMNS['unit_price']} AS unit_price",
    )
    return temporal.as_of_join(
        lines, quotes, ["product_id"], "order_date", "quoted_on", ["unit_price"]
    )


CAMPAIGN_START = "s_suppkey * 97 % 2300"
CAMPAIGN_DAYS = "CASE WHEN s_suppkey % 25 = 0 THEN 700 ELSE s_suppkey % 60 END"


@QUERIES.query(
    with_star(
        """SELECT campaign_id, count(*) AS orders,
                  CAST(sum(datediff('day', greatest(starts, order_date), least(ends, delivered_date)) + 1)
                       AS BIGINT) AS days
           FROM campaigns JOIN star_orders ON city = ship_city
               AND starts <= delivered_date AND ends >= order_date
           GROUP BY campaign_id""",
        f"""campaigns AS (
            SELECT s_suppkey AS campaign_id, n_name AS city,
                   CAST(DATE '1995-01-01' + CAST({CAMPAIGN_START} AS INTEGER) AS DATE) AS starts,
                   CAST(DATE '1995-01-01' + CAST({CAMPAIGN_START} + {CAMPAIGN_DAYS} AS INTEGER)
                        AS DATE) AS ends
            FROM supplier JOIN nation ON n_nationkey = s_nationkey)""",
    )
)
def campaign_deliveries(w: Wholesale) -> DataFrame:
    """For each campaign of a nation, the orders on their way during it, and for how many days."""
    campaigns = (
        w.source("supplier")
        .join(w.source("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .selectExpr(
            "s_suppkey AS campaign_id",
            "n_name AS city",
            f"date_add(DATE'1995-01-01', CAST({CAMPAIGN_START} AS INT)) AS starts",
            f"date_add(DATE'1995-01-01', CAST({CAMPAIGN_START} + {CAMPAIGN_DAYS} AS INT)) AS ends",
        )
    )
    orders = w.orders("order_date", "delivered_date", "ship_city").withColumnRenamed(
        "ship_city", "city"
    )
    pairs = temporal.overlap_join(
        campaigns, orders, ("starts", "ends"), ("order_date", "delivered_date"), ["city"]
    )
    common = F.datediff(F.least("ends", "delivered_date"), F.greatest("starts", "order_date")) + 1
    return pairs.groupBy("campaign_id").agg(
        F.count("*").alias("orders"), F.sum(common).alias("days")
    )
