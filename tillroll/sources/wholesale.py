"""The commerce star read from wholesale-style tables (customer, part, orders, lineitem, ...).

Every table method takes the columns it is asked for, and joins other source tables only when a
wanted column comes from there.  ``ADAPTER_SQL`` states the same mapping as SQL, for checking.

============== ====================================================================
canonical      source
============== ====================================================================
customers      customer, with nation as city, region as state, first order as signup; some
               are left out (so that orders have unknown buyers), some share an address, and
               some have no signup date
products       part, type as category, brand as brand, retail price as unit cost; some are
               left out
orders         orders, status F/P/O as Delivered/Returned/Cancelled, priority as
               channel, market segment as payment method, region as carrier, newest
               line shipped on or after the order date as delivery date
order_items    lineitem, extended price as list price, less its discount
payments       orders, one payment each; totals under 50,000 count as failed
============== ====================================================================
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.functions.numeric import CANCELLED, DELIVERED, RETURNED
from tillroll.session import last_change
from tillroll.sources.schemas import TABLES, Star

# Source status letters, the day histories are measured from, and the rules that
# stand in for attributes the source lacks.
STATUS = {"F": DELIVERED, "P": RETURNED, "O": CANCELLED}
AS_OF = datetime.date(2001, 8, 2)
FAILED_BELOW = 50_000
CASH_SEGMENT = "HOUSEHOLD"
KNOWN_CUSTOMER = "c_custkey % 50 <> 7"
KNOWN_PRODUCT = "p_partkey % 40 <> 3"
SIGNED_UP = "customer_id % 30 <> 11"

_BUYER_COLUMNS = ("payment_method", "ship_carrier", "ship_city", "ship_state")


def _cents(amount: str) -> str:
    """Whole hundredths of a source number, which is a double with two decimals."""
    return f"CAST(rint({amount} * 100) AS BIGINT)"


def _money(cents: str, digits: int) -> str:
    """Whole cents as exact decimal money; much cheaper than casting a double to decimal."""
    return f"CAST(CAST({cents} AS DECIMAL(12,0)) * 0.01BD AS DECIMAL({digits},2))"


def _share(cents: str, hundredths: str) -> str:
    """A percentage of some cents, rounded half up."""
    return f"(({cents} * {hundredths} + 50) div 100)"


_PRICE = _cents("p_retailprice")
_LINE = _cents("l_extendedprice")
_CUT = _share(_LINE, _cents("l_discount"))
_TOTAL = _cents("o_totalprice")
_TAX = _share(_TOTAL, "15")
_STATUS_CASE = " ".join(f"WHEN '{letter}' THEN '{name}'" for letter, name in STATUS.items())

# Canonical column by source expression; columns that need a join are added by the methods.
CUSTOMER_COLUMNS = {
    "customer_id": "c_custkey",
    "full_name": "c_name",
    # a few offices share one address
    "email": "CASE WHEN c_custkey % 100 = 0 THEN concat('office', c_custkey % 700) "
    "ELSE lower(translate(c_name, '#', '.')) END",
    "age": "CAST(floor(abs(c_acctbal) / 200) + 18 AS INT)",
    "segment": "c_mktsegment",
    # accounts in debt are closed, modest ones are not flagged and take the default
    "is_active": "CASE WHEN c_acctbal < 0 THEN false WHEN c_acctbal < 5000 THEN true END",
}
PRODUCT_COLUMNS = {
    "product_id": "p_partkey",
    "sku": "concat(p_brand, '-', p_partkey)",
    "product_name": "p_name",
    "category": "p_type",
    "sub_category": "concat('Size ', p_size)",
    "brand": "p_brand",
    "list_price": _money(_PRICE, 10),
    "unit_cost": _money(_PRICE, 10),
    "launch_date": "date_add(DATE'1995-01-01', p_size * 30)",
    "is_discontinued": "CASE WHEN p_size > 45 THEN true WHEN p_size > 10 THEN false END",
}
ORDER_COLUMNS = {
    "order_id": "o_orderkey",
    "customer_id": "o_custkey",
    "order_date": "CAST(o_orderdate AS DATE)",
    "channel": "o_orderpriority",
    "order_status": f"CASE o_orderstatus {_STATUS_CASE} END",
}
ITEM_COLUMNS = {
    "order_id": "l_orderkey",
    "line_no": "l_linenumber",
    "product_id": "l_partkey",
    "quantity": "CAST(l_quantity AS INT)",
    "list_price": _money(_LINE, 10),
    "discount_amount": _money(_CUT, 10),
    "unit_price": _money(f"({_LINE} - {_CUT})", 10),
}
PAYMENT_COLUMNS = {
    "order_id": "o_orderkey",
    "customer_id": "o_custkey",
    "subtotal": _money(f"({_TOTAL} - {_TAX})", 12),
    "tax_amount": _money(_TAX, 12),
    "shipping_fee": "CAST(0 AS DECIMAL(12,2))",
    "grand_total": _money(_TOTAL, 12),
    "payment_status": f"CASE WHEN o_totalprice < {FAILED_BELOW} THEN 'Failed' ELSE 'Paid' END",
}

# Footers are read once per session and state of a table.
_SCHEMAS: dict[tuple, StructType] = {}
SOURCES = ("region", "nation", "customer", "part", "orders", "lineitem")


def _pick(df: DataFrame, mapping: dict[str, str], names: Iterable[str]) -> DataFrame:
    """The mapped columns among ``names``, each once."""
    return df.selectExpr(*[f"{mapping[n]} AS {n}" for n in dict.fromkeys(names) if n in mapping])


def _wanted(table: str, columns: Sequence[str]) -> tuple[str, ...]:
    return tuple(columns) or tuple(name for name, _ in TABLES[table].columns)


class Wholesale:
    """Canonical tables over a folder of wholesale Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def version(self) -> tuple:
        """When each of the tables behind the star was last changed."""
        paths = (f"{self.folder}/{name}.parquet" for name in SOURCES)
        return tuple(last_change(self.spark, path) for path in paths)

    def source(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path, last_change(self.spark, path))
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    def customers(self, *columns: str, only: DataFrame | None = None) -> DataFrame:
        """Customers; ``only`` names the ids needed, and keeps other orders out of the search for
        the first one."""
        wanted = _wanted("customers", columns)
        placed = not {"city", "state"}.isdisjoint(wanted)
        dated = "signup_date" in wanted
        rows = self.source("customer").filter(KNOWN_CUSTOMER)
        ids = None if only is None else only.select(F.col("customer_id").alias("id"))
        if ids is not None:
            rows = rows.join(ids, F.col("c_custkey") == F.col("id"), "left_semi")
        if placed:
            rows = rows.join(self._places(), "c_nationkey", "left")
        mapping = CUSTOMER_COLUMNS | {"city": "city", "state": "state"}
        kept = _pick(rows, mapping, (*wanted, *(("customer_id",) if dated else ())))
        if dated:
            bought = self.source("orders")
            if ids is not None:
                bought = bought.join(ids, F.col("o_custkey") == F.col("id"), "left_semi")
            first = (
                bought.groupBy(F.col("o_custkey").alias("customer_id"))
                .agg(F.expr("min(CAST(o_orderdate AS DATE))").alias("signup_date"))
                .filter(SIGNED_UP)
            )
            kept = kept.join(first, "customer_id", "left")
        return kept.select(*wanted)

    def products(self, *columns: str) -> DataFrame:
        known = self.source("part").filter(KNOWN_PRODUCT)
        return _pick(known, PRODUCT_COLUMNS, _wanted("products", columns))

    def orders(
        self,
        *columns: str,
        statuses: Sequence[str] | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame:
        """Orders; ``statuses`` names the only ones needed, as a filter the scan can push down,
        and ``only`` the ids needed, which keeps other orders' lines out of the search for the
        newest."""
        wanted = _wanted("orders", columns)
        ids = None if only is None else only.select(F.col("order_id").alias("id"))
        dated = "delivered_date" in wanted
        bought = not set(_BUYER_COLUMNS).isdisjoint(wanted)
        stored = self.source("orders")
        if statuses is not None:
            letters = [letter for letter, name in STATUS.items() if name in statuses]
            stored = stored.filter(F.col("o_orderstatus").isin(letters))
        if ids is not None:
            stored = stored.join(ids, F.col("o_orderkey") == F.col("id"), "left_semi")
        helpers = ("order_id", "order_date", "order_status") if dated else ()
        rows = _pick(
            stored, ORDER_COLUMNS, (*wanted, *helpers, *(("customer_id",) if bought else ()))
        )
        if dated:
            # the newest line is the newest one on or after the order date, if there is any
            lines = self.source("lineitem")
            if ids is not None:
                lines = lines.join(ids, F.col("l_orderkey") == F.col("id"), "left_semi")
            shipped = (
                lines.groupBy(F.col("l_orderkey").alias("order_id"))
                .agg(F.expr("max(CAST(l_shipdate AS DATE))").alias("shipped"))
            )
            rows = rows.join(shipped, "order_id", "left").withColumn(
                "delivered_date",
                F.expr(
                    f"CASE WHEN shipped >= order_date AND order_status <> '{CANCELLED}' "
                    "THEN shipped END"
                ),
            )
        if bought:
            rows = rows.join(self._buyers(), "customer_id", "left")
        return rows.select(*wanted)

    def order_items(self, *columns: str) -> DataFrame:
        return _pick(self.source("lineitem"), ITEM_COLUMNS, _wanted("order_items", columns))

    def payments(self, *columns: str, paid_only: bool = False) -> DataFrame:
        """Payments; ``paid_only`` drops failed ones by a filter the scan can push down."""
        wanted = _wanted("payments", columns)
        bought = "payment_method" in wanted
        stored = self.source("orders")
        if paid_only:
            stored = stored.filter(F.col("o_totalprice") >= FAILED_BELOW)
        rows = _pick(stored, PAYMENT_COLUMNS, (*wanted, *(("customer_id",) if bought else ())))
        if bought:
            rows = rows.join(
                self._buyers().select("customer_id", "payment_method"), "customer_id", "left"
            )
        return rows.select(*wanted)

    def tables(self) -> dict[str, DataFrame]:
        """All five tables with all their columns."""
        return {name: getattr(self, name)() for name in TABLES}

    def star(self) -> Star:
        return Star(**self.tables())

    def _places(self) -> DataFrame:
        nations, regions = self.source("nation"), self.source("region")
        same_region = nations["n_regionkey"] == regions["r_regionkey"]
        return nations.join(regions, same_region, "left").selectExpr(
            "n_nationkey AS c_nationkey", "n_name AS city", "r_name AS state"
        )

    def _buyers(self) -> DataFrame:
        return (
            self.source("customer")
            .join(self._places(), "c_nationkey", "left")
            .selectExpr(
                "c_custkey AS customer_id",
                "c_mktsegment AS payment_method",
                "state AS ship_carrier",
                "city AS ship_city",
                "state AS ship_state",
            )
        )


# The mapping above as SQL common table expressions, by canonical table.
ADAPTER_SQL = {
    "customers": """
        star_customers AS (
            SELECT c_custkey AS customer_id, c_name AS full_name,
                   CASE WHEN c_custkey % 100 = 0 THEN 'office' || (c_custkey % 700)
                        ELSE lower(translate(c_name, '#', '.')) END AS email,
                   n_name AS city, r_name AS state,
                   CAST(floor(abs(c_acctbal) / 200) + 18 AS INTEGER) AS age,
                   c_mktsegment AS segment, signup_date,
                   CASE WHEN c_acctbal < 0 THEN FALSE WHEN c_acctbal < 5000 THEN TRUE END
                       AS is_active
            FROM customer
            LEFT JOIN nation ON n_nationkey = c_nationkey
            LEFT JOIN region ON r_regionkey = n_regionkey
            LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS signup_date
                       FROM orders GROUP BY o_custkey)
                ON o_custkey = c_custkey AND c_custkey % 30 <> 11
            WHERE c_custkey % 50 <> 7)""",
    "products": """
        star_products AS (
            SELECT p_partkey AS product_id, p_brand || '-' || p_partkey AS sku,
                   p_name AS product_name, p_type AS category,
                   'Size ' || p_size AS sub_category, p_brand AS brand,
                   CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
                   CAST(p_retailprice AS DECIMAL(10,2)) AS unit_cost,
                   CAST(DATE '1995-01-01' + CAST(p_size * 30 AS INTEGER) AS DATE) AS launch_date,
                   CASE WHEN p_size > 45 THEN TRUE WHEN p_size > 10 THEN FALSE END
                       AS is_discontinued
            FROM part WHERE p_partkey % 40 <> 3)""",
    "orders": """
        star_orders AS (
            SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                   CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS channel,
                   c_mktsegment AS payment_method, r_name AS ship_carrier,
                   CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Returned'
                                      WHEN 'O' THEN 'Cancelled' END AS order_status,
                   CASE WHEN o_orderstatus <> 'O' THEN arrived END AS delivered_date,
                   n_name AS ship_city, r_name AS ship_state
            FROM orders
            LEFT JOIN customer ON c_custkey = o_custkey
            LEFT JOIN nation ON n_nationkey = c_nationkey
            LEFT JOIN region ON r_regionkey = n_regionkey
            LEFT JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS arrived
                       FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                       WHERE l_shipdate >= o_orderdate
                       GROUP BY l_orderkey) ON l_orderkey = o_orderkey)""",
    "order_items": """
        star_items AS (
            SELECT order_id, line_no, product_id, quantity, list_price, discount_amount,
                   CAST(list_price - discount_amount AS DECIMAL(10,2)) AS unit_price
            FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
                         CAST(l_quantity AS INTEGER) AS quantity,
                         CAST(l_extendedprice AS DECIMAL(10,2)) AS list_price,
                         CAST(round(CAST(l_extendedprice AS DECIMAL(10,2))
                                    * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(10,2))
                             AS discount_amount
                  FROM lineitem))""",
    "payments": """
        star_payments AS (
            SELECT order_id, payment_method,
                   CAST(grand_total - tax_amount AS DECIMAL(12,2)) AS subtotal, tax_amount,
                   CAST(0 AS DECIMAL(12,2)) AS shipping_fee, grand_total, payment_status
            FROM (SELECT o_orderkey AS order_id, c_mktsegment AS payment_method,
                         CAST(o_totalprice AS DECIMAL(12,2)) AS grand_total,
                         CAST(round(CAST(o_totalprice AS DECIMAL(12,2))
                                    * CAST(0.15 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2))
                             AS tax_amount,
                         CASE WHEN o_totalprice < 50000 THEN 'Failed' ELSE 'Paid' END
                             AS payment_status
                  FROM orders LEFT JOIN customer ON c_custkey = o_custkey))""",
}
