"""The same analyses as SQL over the wholesale-style tables, for an independent engine.

Ratios are rounded half up on whole numbers (``//`` is whole division), money is summed as
decimal, and both are turned into doubles at the very end.
"""

from __future__ import annotations

from tillroll.operators.facts import FACT_COLUMNS, SAMPLE_COLUMNS
from tillroll.plans import stored, timed
from tillroll.plans.sql import ALIASES
from tillroll.plans.sql import day as _day
from tillroll.plans.sql import pct as _pct
from tillroll.plans.sql import with_star as _with
from tillroll.sources.schemas import TABLES
from tillroll.sources.wholesale import AS_OF, CASH_SEGMENT

_PAID = """paid AS (
    SELECT o.*, p.grand_total
    FROM star_orders o JOIN star_payments p USING (order_id)
    WHERE o.order_status = 'Delivered' AND p.payment_status = 'Paid')"""

_BILLED = """billed AS (
    SELECT o.order_id, o.order_date, p.grand_total
    FROM star_orders o JOIN star_payments p USING (order_id)
    WHERE o.order_status <> 'Cancelled' AND p.payment_status = 'Paid')"""

_SOLD = """sold AS (
    SELECT i.*, o.order_date, o.order_status, g.category, g.brand, g.product_name, g.unit_cost,
           i.quantity * i.unit_price AS amount
    FROM star_items i
    JOIN star_orders o USING (order_id)
    JOIN star_products g USING (product_id)
    WHERE o.order_status <> 'Cancelled')"""

_FACT = """fact AS (
    SELECT o.order_id, o.order_date, o.order_status, o.channel, o.ship_carrier, o.delivered_date,
           c.customer_id, c.full_name, c.city, c.state, c.age, c.segment, c.signup_date,
           g.product_id, g.product_name, g.category, g.sub_category, g.brand, g.unit_cost,
           i.line_no, i.quantity, i.list_price AS item_list_price, i.discount_amount,
           i.unit_price, p.grand_total, p.tax_amount, p.shipping_fee, p.payment_status,
           p.payment_method
    FROM star_items i
    JOIN star_products g USING (product_id)
    JOIN star_orders o USING (order_id)
    JOIN star_payments p USING (order_id)
    JOIN star_customers c USING (customer_id))"""

_FACT_ORDERS = """fact_orders AS (
    SELECT DISTINCT order_id, ship_carrier, order_status FROM fact)"""

_RFM = """spend AS (
    SELECT customer_id, max(order_date) AS last_order, count(*) AS frequency,
           sum(grand_total) AS monetary
    FROM (SELECT DISTINCT order_id, customer_id, order_date, grand_total FROM fact
          WHERE order_status = 'Delivered' AND payment_status = 'Paid')
    GROUP BY customer_id),
base AS (
    SELECT *, datediff('day', last_order, (SELECT max(last_order) FROM spend) + 1) AS recency
    FROM spend)"""

_SCORED = """placed AS (
    SELECT *, count(*) OVER () AS n,
           row_number() OVER (ORDER BY frequency, customer_id) AS f_place,
           row_number() OVER (ORDER BY monetary, customer_id) AS m_place
    FROM base),
quartered AS (
    SELECT quantile_cont(CAST(recency AS DOUBLE), [0.25, 0.5, 0.75]) AS cuts FROM base),
scored AS (
    SELECT customer_id, last_order, frequency, monetary, recency,
           CASE WHEN recency <= cuts[1] THEN 4 WHEN recency <= cuts[2] THEN 3
                WHEN recency <= cuts[3] THEN 2 ELSE 1 END AS R_score,
           greatest(1, (4 * (f_place - 1) + n - 2) // greatest(n - 1, 1)) AS F_score,
           greatest(1, (4 * (m_place - 1) + n - 2) // greatest(n - 1, 1)) AS M_score
    FROM placed CROSS JOIN quartered),
segmented AS (
    SELECT *, R_score + F_score + M_score AS RFM_score,
           CASE WHEN R_score + F_score + M_score >= 10 THEN 'Champions'
                WHEN R_score + F_score + M_score >= 8 THEN 'Loyal'
                WHEN R_score + F_score + M_score >= 5 THEN 'Potential'
                ELSE 'At-Risk' END AS segment
    FROM scored)"""

_RFM_OUT = f"""customer_id, {_day('last_order')}, CAST(frequency AS BIGINT) AS frequency,
       CAST(monetary AS DOUBLE) AS monetary, CAST(recency AS BIGINT) AS recency"""

_SCORES_OUT = """CAST(R_score AS BIGINT) AS R_score, CAST(F_score AS BIGINT) AS F_score,
       CAST(M_score AS BIGINT) AS M_score, CAST(RFM_score AS BIGINT) AS RFM_score"""


def _plain(column: str) -> str:
    """Output form of a fact column."""
    kinds = {name: kind for spec in TABLES.values() for name, kind in spec.columns}
    kind = kinds[column.removeprefix("item_")].simpleString()
    if kind.startswith("decimal"):
        return f"CAST({column} AS DOUBLE) AS {column}"
    if kind == "date":
        return _day(column)
    if kind == "int":
        return f"CAST({column} AS BIGINT) AS {column}"
    return column


def _profile() -> str:
    rows = []
    for table, spec in TABLES.items():
        for position, (column, kind) in enumerate(spec.columns, 1):
            rows.append(
                f"SELECT '{table}' AS table_name, CAST({position} AS BIGINT) AS position, "
                f"'{column}' AS column_name, '{kind.simpleString()}' AS column_type, "
                f"count({column}) AS filled_rows FROM {ALIASES[table]}"
            )
    return "\nUNION ALL ".join(rows)


def _repeated(table: str, columns: tuple[str, ...]) -> str:
    value = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(columns)}' AS key_columns, "
        f"{value} AS key_value, count(*) AS row_count "
        f"FROM {ALIASES[table]} GROUP BY {', '.join(columns)} HAVING count(*) > 1"
    )


def _missing(table: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"'{parent}' AS parent_table, CAST(c.{column} AS VARCHAR) AS missing_key, "
        f"count(*) AS row_count FROM {ALIASES[table]} c "
        f"WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {ALIASES[parent]} p WHERE p.{column} = c.{column}) "
        f"GROUP BY c.{column}"
    )


def _null_rows() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"count(*) - count({column}) AS null_count FROM {ALIASES[table]}"
        for table, spec in TABLES.items()
        for column in spec.not_null
    )


def _defaults() -> str:
    parts = []
    for table, spec in TABLES.items():
        for column, default in spec.defaults.items():
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"coalesce({column}, {str(default).upper()}) AS flag_value, "
                f"count(*) AS row_count, count(*) - count({column}) AS defaulted_rows "
                f"FROM {ALIASES[table]} GROUP BY 3"
            )
    return "\nUNION ALL ".join(parts)


def _null_summary() -> str:
    derived = {
        "revenue": "unit_price * quantity",
        "profit": "(unit_price - unit_cost) * quantity",
        "discount_pct": "discount_amount / nullif(item_list_price, 0)",
        "delivery_days": "delivered_date - order_date",
        "order_month": "date_trunc('month', order_date)",
    }
    values = {c: c for c in FACT_COLUMNS} | derived
    counts = ",\n       ".join(f"count(*) - count({v}) AS {c}" for c, v in values.items())
    return (
        f"SELECT column_name, null_count FROM (UNPIVOT (SELECT {counts} FROM fact) "
        "ON COLUMNS(*) INTO NAME column_name VALUE null_count) WHERE null_count > 0"
    )


def _describe() -> str:
    def quartile(metric: str, quarter: int) -> str:
        spot = f"{quarter} * (n - 1)"
        low = f"{metric}_cents[1 + ({spot}) // 4]"
        high = f"{metric}_cents[least(n, 2 + ({spot}) // 4)]"
        rest = f"(({spot}) % 4)"
        return f"CAST(({low} * (4 - {rest}) + {high} * {rest} + 2) // 4 AS DOUBLE) / 100.0"

    def mean(metric: str) -> str:
        return f"CAST((2 * {metric}_total + n) // (2 * n) AS DOUBLE) / 100.0"

    rows = {
        "count": lambda m: "CAST(n AS DOUBLE)",
        "mean": mean,
        "std": lambda m: f"round({m}_std, 2)",
        "min": lambda m: f"{m}_cents[1] / 100.0",
        "25%": lambda m: quartile(m, 1),
        "50%": lambda m: quartile(m, 2),
        "75%": lambda m: quartile(m, 3),
        "max": lambda m: f"{m}_cents[n] / 100.0",
    }
    metrics = ("recency", "frequency", "monetary")
    summed = "summed AS (SELECT count(*) AS n, " + ", ".join(
        f"list(CAST({m} * 100 AS BIGINT) ORDER BY {m}) AS {m}_cents, "
        f"CAST(sum({m} * 100) AS HUGEINT) AS {m}_total, "
        f"stddev_samp(CAST({m} AS DOUBLE)) AS {m}_std"
        for m in metrics
    )
    body = "\nUNION ALL ".join(
        f"SELECT '{name}' AS statistic, "
        + ", ".join(f"{rule(m)} AS {m}" for m in metrics)
        + " FROM summed"
        for name, rule in rows.items()
    )
    return _with(body, _FACT, _RFM, summed + " FROM base)")


def oracle_sql() -> dict[str, str]:
    month = "strftime(order_date, '%Y-%m')"
    days = "datediff('day', order_date, delivered_date)"
    sql: dict[str, str] = {}

    sql["src_schemas"] = _with(_profile())
    sql["src_csv"] = _with(
        f"""SELECT CAST(order_id AS VARCHAR) AS order_id,
                   CAST(customer_id AS VARCHAR) AS customer_id, {_day('order_date')}, channel,
                   payment_method, ship_carrier, order_status, {_day('delivered_date')},
                   ship_city, ship_state FROM star_orders"""
    )
    sql["src_rows"] = """
        SELECT o_orderkey AS order_id, c_mktsegment AS payment_method,
               CAST(CAST(o_totalprice / CAST(1.18 AS DOUBLE) AS DECIMAL(12,2)) AS DOUBLE)
                   AS subtotal,
               CAST(CAST(o_totalprice - o_totalprice / CAST(1.18 AS DOUBLE) AS DECIMAL(12,2))
                   AS DOUBLE) AS tax_amount,
               CAST(0 AS DOUBLE) AS shipping_fee,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS grand_total,
               CASE WHEN o_totalprice < 50000 THEN 'Failed' ELSE 'Paid' END AS payment_status
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
    sql["src_sql_pull"] = _with(
        """SELECT channel, count(*) AS orders, CAST(sum(grand_total) AS DOUBLE) AS revenue
           FROM star_orders o, star_payments p
           WHERE o.order_id = p.order_id AND order_date >= DATE '1998-01-01'
             AND payment_status = 'Paid'
           GROUP BY channel"""
    )
    sql["src_parse_dates"] = _with(
        f"""SELECT order_id, {_day('order_date')}, {_day('delivered_date')},
                   {_day('signup_date')},
                   concat_ws(',', CASE WHEN order_date IS NULL THEN 'order_date' END,
                             CASE WHEN delivered_date IS NULL THEN 'delivered_date' END)
                       AS misfits
            FROM (SELECT * REPLACE (CASE WHEN order_id % 3 = 0 OR order_id % 7 <> 0
                                         THEN order_date END AS order_date)
                  FROM star_orders) AS dated
            JOIN star_customers USING (customer_id)"""
    )
    sql["snk_csv"] = _with(
        f"SELECT {_RFM_OUT}, {_SCORES_OUT}, segment FROM segmented", _FACT, _RFM, _SCORED
    )
    sql["row_counts"] = _with(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {alias}"
            for t, alias in ALIASES.items()
        )
    )

    sql["dq_primary_key"] = _with(
        "\nUNION ALL ".join(_repeated(t, spec.primary_key) for t, spec in TABLES.items())
    )
    sql["dq_unique"] = _with(
        "\nUNION ALL ".join(
            [_repeated(t, (c,)) for t, spec in TABLES.items() for c in spec.unique]
            + [_repeated("products", ("product_name",))]
        )
    )
    sql["dq_not_null"] = _with(_null_rows())
    sql["dq_foreign_key"] = _with(
        "\nUNION ALL ".join(
            _missing(*relation)
            for relation in [
                *((t, c, parent) for t, spec in TABLES.items() for c, parent in spec.references),
                ("orders", "order_id", "order_items"),
            ]
        )
    )
    sql["dq_default"] = _with(_defaults())
    sql["q01_dup_emails"] = _with(
        """SELECT email, count(*) AS count FROM star_customers WHERE email IS NOT NULL
           GROUP BY email HAVING count(*) > 1"""
    )
    sql["src_load"] = _with(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count, "
            + ("count(*) FILTER (order_id % 97 = 0)" if t == "orders" else "0::BIGINT")
            + f" AS rejected_lines FROM {alias}"
            for t, alias in ALIASES.items()
        )
    )
    sql["q02_null_audit"] = _with(
        """SELECT order_status, count(*) AS total_orders,
                  count(*) - count(delivered_date) AS null_delivered_date,
                  count(delivered_date) AS has_delivered_date
           FROM star_orders GROUP BY order_status"""
    )
    sql["null_summary"] = _with(_null_summary(), _FACT)
    sql["describe_metrics"] = _describe()
    sql["preview"] = _with(
        f"""SELECT {', '.join(_plain(c) for c, _ in TABLES['orders'].columns)},
                   (SELECT count(*) FROM orders) AS row_count, CAST(10 AS BIGINT) AS column_count
            FROM star_orders ORDER BY order_id LIMIT 5"""
    )

    sql["q03_status_dist"] = _with(
        f"""SELECT order_status, n AS order_count,
                   {_pct('n', '(SELECT count(*) FROM star_orders)')} AS percentage
            FROM (SELECT order_status, count(*) AS n FROM star_orders GROUP BY ALL)"""
    )
    sql["status_counts_distinct"] = _with(
        """SELECT order_status, count(*) AS count
           FROM (SELECT DISTINCT order_id, order_status FROM fact) GROUP BY order_status""",
        _FACT,
    )
    sql["q04_total_revenue"] = _with(
        "SELECT CAST(sum(grand_total) AS DOUBLE) AS total_revenue FROM paid", _PAID
    )
    delivered = """FROM star_orders JOIN star_payments USING (order_id)
                   WHERE order_status = 'Delivered'"""
    sql["q04_delivered_revenue"] = _with(
        f"SELECT CAST(sum(grand_total) AS DOUBLE) AS total_revenue {delivered}"
    )
    sql["q05_delivered_by_month"] = _with(
        f"""SELECT {month} AS month, count(DISTINCT order_id) AS order_count,
                   CAST(sum(grand_total) AS DOUBLE) AS monthly_revenue
            {delivered} GROUP BY 1"""
    )
    sql["q05_monthly_revenue"] = _with(
        f"""SELECT {month} AS month, count(DISTINCT order_id) AS order_count,
                   CAST(sum(grand_total) AS DOUBLE) AS monthly_revenue
            FROM paid GROUP BY 1""",
        _PAID,
    )
    sql["q06_channel_month"] = _with(
        f"""SELECT {month} AS month, channel, count(DISTINCT order_id) AS orders,
                   CAST(sum(grand_total) AS DOUBLE) AS revenue
            FROM paid GROUP BY 1, 2""",
        _PAID,
    )
    sql["daily_revenue"] = _with(
        """SELECT strftime(order_date, '%Y-%m-%d') AS order_date,
                  CAST(sum(grand_total) AS DOUBLE) AS revenue
           FROM billed GROUP BY ALL""",
        _BILLED,
    )
    sql["monthly_revenue_chart"] = _with(
        """SELECT strftime(date_trunc('month', order_date), '%Y-%m-%d') AS order_month,
                  CAST(sum(grand_total) AS DOUBLE) AS grand_total
           FROM (SELECT DISTINCT order_id, order_date, grand_total FROM fact
                 WHERE order_status IN ('Delivered', 'Returned') AND payment_status = 'Paid')
           GROUP BY ALL""",
        _FACT,
    )

    sql["q07_top_customers"] = _with(
        """SELECT c.customer_id, c.full_name, c.city, c.segment,
                  count(DISTINCT order_id) AS total_orders,
                  CAST(sum(grand_total) AS DOUBLE) AS lifetime_revenue
           FROM paid JOIN star_customers c USING (customer_id) GROUP BY ALL
           ORDER BY sum(grand_total) DESC, customer_id LIMIT 10""",
        _PAID,
    )
    sql["q08_repeat_rate"] = _with(
        f"""SELECT count(*) FILTER (n > 1) AS repeat_customers, count(*) AS total_customers,
                   {_pct('count(*) FILTER (n > 1)', 'count(*)')} AS repeat_rate_pct
            FROM (SELECT customer_id, count(DISTINCT order_id) AS n FROM star_orders
                  WHERE order_status = 'Delivered' GROUP BY customer_id)"""
    )
    sql["q09_cohort_retention"] = _with(
        """SELECT strftime(signup_date, '%Y-%m') AS cohort_month,
                  12 * (year(order_date) - year(signup_date))
                      + month(order_date) - month(signup_date) AS months_since_signup,
                  count(DISTINCT customer_id) AS active_customers
           FROM star_orders JOIN star_customers USING (customer_id)
           WHERE order_status = 'Delivered' GROUP BY 1, 2"""
    )
    sql["q17_customer_history"] = _with(
        f"""SELECT customer_id, full_name, {_day('first_order_date')}, {_day('last_order_date')},
                   datediff('day', last_order_date, DATE '{AS_OF}') AS days_since_last_order,
                   total_orders, CAST(lifetime_value AS DOUBLE) AS lifetime_value
            FROM (SELECT customer_id, min(order_date) AS first_order_date,
                         max(order_date) AS last_order_date, count(*) AS total_orders,
                         sum(grand_total) AS lifetime_value
                  FROM paid GROUP BY customer_id)
            JOIN star_customers USING (customer_id)""",
        _PAID,
    )
    sql["q17b_running_spend"] = _with(
        """SELECT customer_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date,
                  row_number() OVER in_turn AS order_number,
                  CAST(sum(grand_total) OVER in_turn AS DOUBLE) AS running_total_spend
           FROM paid JOIN star_customers USING (customer_id)
           WINDOW in_turn AS (PARTITION BY customer_id ORDER BY paid.order_date, order_id
                              ROWS UNBOUNDED PRECEDING)""",
        _PAID,
    )
    sql["rfm_base"] = _with(f"SELECT {_RFM_OUT} FROM base", _FACT, _RFM)
    sql["rfm_scores"] = _with(
        f"SELECT customer_id, {_SCORES_OUT} FROM segmented", _FACT, _RFM, _SCORED
    )
    sql["rfm_segment"] = _with(
        "SELECT customer_id, segment FROM segmented", _FACT, _RFM, _SCORED
    )
    sql["rfm_segment_summary"] = _with(
        """SELECT segment, n AS customers,
                  CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100.0 AS avg_revenue,
                  CAST((200 * orders + n) // (2 * n) AS DOUBLE) / 100.0 AS avg_orders
           FROM (SELECT segment, count(*) AS n, CAST(sum(monetary) * 100 AS HUGEINT) AS cents,
                        sum(frequency) AS orders
                 FROM segmented GROUP BY segment)""",
        _FACT,
        _RFM,
        _SCORED,
    )
    sql["rfm_segment_counts"] = _with(
        "SELECT segment, count(*) AS count FROM segmented GROUP BY segment", _FACT, _RFM, _SCORED
    )

    sql["q10a_category_revenue"] = _with(
        """SELECT category, count(DISTINCT order_id) AS order_count,
                  CAST(sum(quantity) AS BIGINT) AS total_quantity,
                  CAST(sum(amount) AS DOUBLE) AS category_revenue
           FROM sold WHERE order_status = 'Delivered' GROUP BY category""",
        _SOLD,
    )
    sql["q10b_category_quantity"] = _with(
        """SELECT category, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
                  CAST(sum(amount) AS DOUBLE) AS category_revenue
           FROM sold WHERE order_status = 'Delivered' GROUP BY category""",
        _SOLD,
    )
    sql["top_categories_chart"] = _with(
        """SELECT category, CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue,
                  CAST(sum(quantity) AS BIGINT) AS quantity
           FROM fact WHERE order_status = 'Delivered' GROUP BY category
           ORDER BY sum(quantity * unit_price) DESC, category LIMIT 8""",
        _FACT,
    )
    sql["q11_discount_impact"] = _with(
        """SELECT category, brand, count(*) AS line_items,
                  round(avg(100.0 * CAST(discount_amount AS DOUBLE)
                            / CAST(list_price AS DOUBLE)), 2) AS avg_discount_pct,
                  CAST(sum(discount_amount) AS DOUBLE) AS total_discount_given
           FROM sold WHERE order_status = 'Delivered' AND list_price > 0 GROUP BY ALL""",
        _SOLD,
    )
    sql["q12_top_profit"] = _with(
        """SELECT product_id, product_name, category, brand,
                  CAST(sum(quantity) AS BIGINT) AS units_sold,
                  CAST(sum((unit_price - unit_cost) * quantity) AS DOUBLE) AS estimated_profit
           FROM sold WHERE order_status = 'Delivered' GROUP BY ALL
           ORDER BY sum((unit_price - unit_cost) * quantity) DESC, product_id LIMIT 10""",
        _SOLD,
    )
    sql["q13_delivery_days"] = _with(
        f"""SELECT ship_carrier, n AS delivered_orders,
                   CAST((200 * total + n) // (2 * n) AS DOUBLE) / 100.0 AS avg_delivery_days,
                   min_days, max_days
            FROM (SELECT ship_carrier, count(*) AS n, CAST(sum({days}) AS BIGINT) AS total,
                         min({days}) AS min_days, max({days}) AS max_days
                  FROM star_orders
                  WHERE order_status = 'Delivered' AND delivered_date IS NOT NULL
                  GROUP BY ship_carrier)"""
    )
    returned = "count(*) FILTER (order_status = 'Returned')"
    sql["q14a_return_carrier"] = _with(
        f"""SELECT ship_carrier, count(*) AS total_orders, {returned} AS returned_orders,
                   {_pct(returned, 'count(*)')} AS return_rate_pct
            FROM star_orders WHERE order_status <> 'Cancelled' GROUP BY ship_carrier"""
    )
    orders_seen = "count(DISTINCT order_id)"
    sql["q14b_return_category"] = _with(
        f"""SELECT category, {orders_seen} AS total_orders, {returned} AS returned_orders,
                   {_pct(returned, orders_seen)} AS return_rate_pct
            FROM sold GROUP BY category""",
        _SOLD,
    )
    returned_seen = "count(DISTINCT order_id) FILTER (order_status = 'Returned')"
    sql["q14b_fixed"] = _with(
        f"""SELECT category, {orders_seen} AS total_orders, {returned_seen} AS returned_orders,
                   {_pct(returned_seen, orders_seen)} AS return_rate_pct
            FROM sold GROUP BY category""",
        _SOLD,
    )
    sql["return_rate_carrier_chart"] = _with(
        f"""SELECT ship_carrier, count(*) AS total, {returned} AS returned,
                   {_pct(returned, 'count(*)')} AS "return_rate_%"
            FROM fact_orders GROUP BY ship_carrier""",
        _FACT,
        _FACT_ORDERS,
    )
    cancelled = "count(*) FILTER (order_status = 'Cancelled')"
    sql["q15_cancel_by_payment"] = _with(
        f"""SELECT payment_method, count(*) AS total_orders, {cancelled} AS cancelled_orders,
                   {_pct(cancelled, 'count(*)')} AS cancellation_rate_pct
            FROM star_orders GROUP BY payment_method"""
    )
    sql["q15b_cod_vs_prepaid"] = _with(
        f"""SELECT CASE WHEN payment_method = '{CASH_SEGMENT}' THEN 'COD' ELSE 'Prepaid' END
                       AS payment_kind,
                   count(*) AS total_orders, {cancelled} AS cancelled_orders,
                   {_pct(cancelled, 'count(*)')} AS cancellation_rate_pct
            FROM star_orders GROUP BY 1"""
    )
    sql["q16_category_rank"] = _with(
        f"""SELECT month, category, CAST(revenue AS DOUBLE) AS revenue,
                   dense_rank() OVER (PARTITION BY month ORDER BY m.revenue DESC)
                       AS revenue_rank
            FROM (SELECT {month} AS month, category, sum(amount) AS revenue
                  FROM sold WHERE order_status = 'Delivered' GROUP BY 1, 2) m""",
        _SOLD,
    )
    for name, column, least in (
        ("q18_basket_pairs", "brand", 1),
        ("q18_category_pairs", "category", 2),
    ):
        sql[name] = _with(
            f"""SELECT category_1, category_2, count(*) AS pair_count,
                       {_pct('count(*)', "(SELECT count(*) FROM star_orders "
                             "WHERE order_status = 'Delivered')")} AS pct_of_orders
                FROM (SELECT category_1, unnest(held[i + 1:]) AS category_2
                      FROM (SELECT held, i, held[i] AS category_1
                            FROM (SELECT held, unnest(range(1, len(held))) AS i FROM baskets)))
                GROUP BY category_1, category_2 HAVING count(*) >= {least}
                ORDER BY count(*) DESC, category_1, category_2 LIMIT 20""",
            _SOLD,
            f"""baskets AS (
                SELECT list_sort(list_distinct(list({column}))) AS held
                FROM sold WHERE order_status = 'Delivered' GROUP BY order_id)""",
        )

    fact_columns = ", ".join(_plain(c) for c in FACT_COLUMNS)
    sql["fact_table"] = _with(f"SELECT {fact_columns} FROM fact", _FACT)
    sql["fact_derived"] = _with(
        f"""SELECT {fact_columns}, CAST(quantity * unit_price AS DOUBLE) AS revenue,
                   CAST(quantity * (unit_price - unit_cost) AS DOUBLE) AS profit,
                   {_pct('cut', 'price')} AS discount_pct,
                   datediff('day', fact.order_date, fact.delivered_date) AS delivery_days,
                   strftime(date_trunc('month', fact.order_date), '%Y-%m-%d') AS order_month
            FROM (SELECT *, CAST(discount_amount * 100 AS BIGINT) AS cut,
                         nullif(CAST(item_list_price * 100 AS BIGINT), 0) AS price
                  FROM fact) AS fact""",
        _FACT,
    )
    sample_order = ", ".join(f"fact.{c}" for c in SAMPLE_COLUMNS)
    sql["fact_sample"] = _with(
        f"""SELECT {', '.join(_plain(c) for c in SAMPLE_COLUMNS)} FROM fact
            ORDER BY {sample_order} LIMIT 1000""",
        _FACT,
    )
    line = "order_id, line_no, product_id"
    line_out = "order_id, CAST(line_no AS BIGINT) AS line_no, product_id"
    sql["line_revenue"] = _with(
        f"""SELECT {line_out}, CAST(quantity * unit_price AS DOUBLE) AS revenue
            FROM star_items"""
    )
    sql["line_profit"] = _with(
        f"""SELECT {line_out}, CAST(quantity * (unit_price - unit_cost) AS DOUBLE) AS profit
            FROM star_items JOIN star_products USING (product_id)"""
    )
    sql["line_discount_pct"] = _with(
        f"""SELECT {line_out}, {_pct('cut', 'price')} AS discount_pct
            FROM (SELECT {line}, CAST(discount_amount * 100 AS BIGINT) AS cut,
                         nullif(CAST(list_price * 100 AS BIGINT), 0) AS price
                  FROM star_items)"""
    )
    sql["delivery_days"] = _with(f"SELECT order_id, {days} AS delivery_days FROM star_orders")
    sql["order_month"] = _with(
        """SELECT order_id, strftime(date_trunc('month', order_date), '%Y-%m-%d') AS order_month
           FROM star_orders"""
    )
    sql["param_query"] = _with(
        f"""SELECT {fact_columns} FROM fact
            WHERE fact.order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
              AND channel = '1-URGENT' AND category = 'ECONOMY'""",
        _FACT,
    )
    sql["month_stored_query"] = sql["param_query"]
    chosen = """order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
                AND channel = '1-URGENT'"""
    sql["range_category_revenue"] = _with(
        f"""SELECT category, count(DISTINCT order_id) AS order_count,
                  CAST(sum(quantity) AS BIGINT) AS total_quantity,
                  CAST(sum(amount) AS DOUBLE) AS category_revenue
           FROM sold JOIN (SELECT order_id, channel FROM star_orders) USING (order_id)
           WHERE order_status = 'Delivered' AND {chosen} GROUP BY category""",
        _SOLD,
    )
    sql["range_monthly_revenue"] = _with(
        f"""SELECT {month} AS month, count(DISTINCT order_id) AS order_count,
                   CAST(sum(grand_total) AS DOUBLE) AS monthly_revenue
            FROM paid WHERE {chosen} GROUP BY 1""",
        _PAID,
    )
    sql["range_carrier_returns"] = _with(
        f"""SELECT ship_carrier, count(*) AS total_orders, {returned} AS returned_orders,
                   {_pct(returned, 'count(*)')} AS return_rate_pct
            FROM star_orders WHERE order_status <> 'Cancelled' AND {chosen}
            GROUP BY ship_carrier"""
    )
    sql["src_csv_multi_line"] = _with(
        """SELECT CAST(customer_id AS VARCHAR) AS customer_id,
                  full_name || chr(10) || 'said "hi", twice' AS full_name, segment
           FROM star_customers"""
    )
    return sql | timed.QUERIES.sql | stored.QUERIES.sql
