"""The five tables of the commerce star: columns, types, keys, defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.IntegerType()
FLAG = T.BooleanType()
DAY = T.DateType()
UNIT_MONEY = T.DecimalType(10, 2)
ORDER_MONEY = T.DecimalType(12, 2)


@dataclass(frozen=True)
class TableSpec:
    """Columns in load order, and the constraints the data is expected to meet."""

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    primary_key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    references: tuple[tuple[str, str], ...] = ()  # (column, parent table with that key column)
    defaults: dict[str, bool] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.columns])

    @property
    def not_null(self) -> tuple[str, ...]:
        """Primary-key columns are NOT NULL as well as those declared so."""
        return self.primary_key + tuple(c for c in self.required if c not in self.primary_key)


# Columns, keys and defaults of the tables.
CUSTOMERS = TableSpec(
    name="customers",
    columns=(
        ("customer_id", TEXT),
        ("full_name", TEXT),
        ("email", TEXT),
        ("city", TEXT),
        ("state", TEXT),
        ("age", WHOLE),
        ("segment", TEXT),
        ("signup_date", DAY),
        ("is_active", FLAG),
    ),
    primary_key=("customer_id",),
    unique=("email",),
    required=("full_name",),
    defaults={"is_active": True},
)

PRODUCTS = TableSpec(
    name="products",
    columns=(
        ("product_id", TEXT),
        ("sku", TEXT),
        ("product_name", TEXT),
        ("category", TEXT),
        ("sub_category", TEXT),
        ("brand", TEXT),
        ("list_price", UNIT_MONEY),
        ("unit_cost", UNIT_MONEY),
        ("launch_date", DAY),
        ("is_discontinued", FLAG),
    ),
    primary_key=("product_id",),
    unique=("sku",),
    required=("product_name",),
    defaults={"is_discontinued": False},
)

ORDERS = TableSpec(
    name="orders",
    columns=(
        ("order_id", TEXT),
        ("customer_id", TEXT),
        ("order_date", DAY),
        ("channel", TEXT),
        ("payment_method", TEXT),
        ("ship_carrier", TEXT),
        ("order_status", TEXT),
        ("delivered_date", DAY),
        ("ship_city", TEXT),
        ("ship_state", TEXT),
    ),
    primary_key=("order_id",),
    required=("customer_id", "order_date"),
    references=(("customer_id", "customers"),),
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    columns=(
        ("order_id", TEXT),
        ("line_no", WHOLE),
        ("product_id", TEXT),
        ("quantity", WHOLE),
        ("list_price", UNIT_MONEY),
        ("discount_amount", UNIT_MONEY),
        ("unit_price", UNIT_MONEY),
    ),
    primary_key=("order_id", "line_no"),
    required=("product_id", "quantity"),
    references=(("order_id", "orders"), ("product_id", "products")),
)

PAYMENTS = TableSpec(
    name="payments",
    columns=(
        ("order_id", TEXT),
        ("payment_method", TEXT),
        ("subtotal", ORDER_MONEY),
        ("tax_amount", ORDER_MONEY),
        ("shipping_fee", ORDER_MONEY),
        ("grand_total", ORDER_MONEY),
        ("payment_status", TEXT),
    ),
    primary_key=("order_id",),
    references=(("order_id", "orders"),),
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)
}


def schema(table: str) -> T.StructType:
    """The typed definition of one table."""
    return TABLES[table].schema


@dataclass(frozen=True)
class Star:
    """The five tables of the commerce star."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame
