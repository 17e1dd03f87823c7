"""A small shop with the awkward rows real data has."""

from tillroll.sources.files import load_rows
from tillroll.sources.schemas import Star

CUSTOMERS = [
    ("C1", "Ann", "ann@example.com", "Pune", "MH", 30, "Consumer", "2023-12-15", 1),
    ("C2", "Bob", "twin@example.com", "Delhi", "DL", 41, "Corporate", "2024-01-31", 0),
    ("C3", "Cid", "twin@example.com", "Delhi", "DL", 25, "SMB", "2024-01-01", None),
    ("C4", "Dot", None, None, None, None, None, None, None),
    ("C5", "Eve", None, "Pune", "MH", 50, "SMB", "2024-02-01", 1),
    ("C5", "Eve again", "eve@example.com", "Pune", "MH", 50, "SMB", "2024-02-01", 1),
]

PRODUCTS = [
    ("P1", "S-1", "Lamp", "Home", "Light", "Lux", 100.0, 60.0, "2020-01-01", 0),
    ("P2", "S-2", "Rug", "Home", "Floor", "Wove", 50.0, 10.0, "2020-01-01", None),
    ("P3", "S-2", "Ball", "Sports", "Play", "Kick", 20.0, 25.0, None, 1),
    ("P4", None, None, "Books", "Novel", "Page", 10.0, None, None, 0),
]

ORDERS = [
    # two orders on one day, in the month after a December signup
    ("O1", "C1", "2024-01-05", "Web", "COD", "Fast", "Delivered", "2024-01-08", "Pune", "MH"),
    ("O2", "C1", "2024-01-05", "Web", "UPI", "Fast", "Delivered", None, "Pune", "MH"),
    # delivered although the payment failed
    ("O3", "C1", "2024-02-01", "Mobile", "Card", "Slow", "Delivered", "2024-02-03", "Pune", "MH"),
    ("O4", "C2", "2024-01-31", "Web", "COD", "Slow", "Returned", "2024-02-10", "Delhi", "DL"),
    ("O5", "C2", "2024-03-01", "Mobile", "UPI", "Fast", "Cancelled", None, "Delhi", "DL"),
    ("O6", "C3", "2024-01-20", "Web", "UPI", "Fast", "Delivered", "2024-01-21", "Delhi", "DL"),
    # no lines
    ("O7", "C3", "2024-04-01", "Web", "Card", "Slow", "Delivered", "2024-04-02", "Delhi", "DL"),
    # unknown customer
    ("O8", "C9", "2024-04-02", "Web", "Card", "Slow", "Delivered", "2024-04-04", "Agra", "UP"),
]

ORDER_ITEMS = [
    ("O1", 1, "P1", 2, 100.0, 10.0, 90.0),
    ("O1", 2, "P2", 1, 50.0, 0.0, 50.0),  # the order's category again
    ("O1", 3, "P3", 3, 20.0, 0.0, 20.0),
    ("O2", 1, "P3", 1, 0.0, 0.0, 0.0),  # free of charge
    ("O2", 2, "P1", 1, None, None, 100.0),
    ("O3", 1, "P2", 2, 50.0, 0.4, 49.6),
    ("O4", 1, "P1", 1, 100.0, 0.0, 100.0),
    ("O4", 2, "P1", 1, 100.0, 0.0, 100.0),
    ("O5", 1, "P2", 1, 50.0, 0.0, 50.0),
    ("O6", 1, "P3", 4, 20.0, 0.0, 20.0),
    ("O6", 1, "P4", 2, 10.0, 0.0, 10.0),  # line number used twice
    ("O8", 1, "P1", 1, 800.0, 1.0, 799.0),
    ("O8", 2, "P9", 1, 5.0, 0.0, 5.0),  # unknown product
    ("O9", 1, "P1", 1, 100.0, 0.0, 100.0),  # unknown order
]

PAYMENTS = [
    ("O1", "COD", 290.0, 0.0, 0, 290.004999999, "Paid"),
    ("O2", "UPI", 100.0, 0.0, 0, 100.0, "Paid"),
    ("O3", "Card", 99.2, 0.0, 0, 99.2, "Failed"),
    ("O4", "COD", 200.0, 0.0, 0, 200.0, "Paid"),
    ("O5", "UPI", 50.0, 0.0, 0, 50.0, "Failed"),
    ("O6", "UPI", 100.0, 0.0, 0, 100.0, "Paid"),
    ("O7", "Card", 70.0, 0.0, 0, 70.0, "Paid"),
    ("O8", "Card", 804.0, 0.0, 0, 804.0, "Paid"),
    ("O10", "Card", 1.0, 0.0, 0, 1.0, "Paid"),  # unknown order
]


def shop(spark) -> Star:
    return Star(
        customers=load_rows(spark, CUSTOMERS, "customers"),
        products=load_rows(spark, PRODUCTS, "products"),
        orders=load_rows(spark, ORDERS, "orders"),
        order_items=load_rows(spark, ORDER_ITEMS, "order_items"),
        payments=load_rows(spark, PAYMENTS, "payments"),
    )


def texts(df, *columns):
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return [" ".join(str(v) for v in row) for row in picked.collect()]
