"""Parts of SQL statements over the wholesale-style tables."""

from __future__ import annotations

from tillroll.sources.wholesale import ADAPTER_SQL

ALIASES = {
    "customers": "star_customers",
    "products": "star_products",
    "orders": "star_orders",
    "order_items": "star_items",
    "payments": "star_payments",
}


def with_star(body: str, *more: str) -> str:
    """Prefix ``body`` with the star tables it names and further table expressions."""
    text = " ".join((*more, body))
    parts = [ADAPTER_SQL[table] for table, alias in ALIASES.items() if alias in text]
    return "WITH " + ",".join([*parts, *more]) + "\n" + body


def pct(part: str, whole: str) -> str:
    return f"CAST((20000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 100.0"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"
