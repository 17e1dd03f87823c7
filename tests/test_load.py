"""The whole load: CSV with dirty lines in, Parquet tables and reports out."""

import datetime
import re

from tests.shop import shop, texts
from tillroll.operators import facts, revenue
from tillroll.plans.load import load_star
from tillroll.sources import files
from tillroll.sources.schemas import TABLES


def test_load(spark, tmp_path):
    star = shop(spark)
    csv = {t: [str(tmp_path / "csv" / t)] for t in TABLES}
    for table, paths in csv.items():
        files.write_csv(getattr(star, table), paths[0])
    extra = tmp_path / "late.csv"
    extra.write_text(
        ",".join(name for name, _ in TABLES["orders"].columns)
        + "\nO20,C1,2024-05-01,Web,UPI,Fast,Delivered,soon,Pune,MH\n"
        + "O21,C1,2024-05-02,Web,UPI,Fast,Delivered,,Pune,MH\n"
    )
    csv["orders"].append(str(extra))

    loaded = load_star(spark, csv, str(tmp_path / "store"), {"orders": 9, "payments": 10})

    assert texts(loaded.rejected["orders"], "order_id") == ["O20"]
    assert loaded.rejected["payments"].count() == 0
    counted = loaded.row_counts.collect()
    counts = {r["table_name"]: (r["row_count"], r["as_expected"]) for r in counted}
    assert counts["orders"] == (9, True) and counts["payments"] == (9, False)
    assert loaded.star.orders.columns == [n for n, _ in TABLES["orders"].columns] + ["order_month"]
    assert loaded.repeated_keys.count() == 2
    assert loaded.repeated_values.count() == 2
    assert texts(loaded.missing_values.filter("null_count > 0")) == [
        "products product_name 1"
    ]
    ranged = facts.fact_query(
        loaded.star, start=datetime.date(2024, 1, 31), end=datetime.date(2024, 2, 1)
    )
    assert sorted(set(texts(ranged, "order_id"))) == ["O3", "O4"]
    physical = ranged._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*order_month", physical)
    assert len(re.findall(r"PartitionFilters: \[[^\]]*placed_month", physical)) == 2
    plain = facts.fact_query(star, start=datetime.date(2024, 1, 31), end=datetime.date(2024, 2, 1))
    lines = [sorted(texts(found, "order_id", "line_no")) for found in (ranged, plain)]
    assert lines[0] == lines[1]
    assert "O9" in texts(loaded.orphans, "missing_key")
    assert texts(revenue.total_revenue(loaded.star.orders, loaded.star.payments)) == ["1364.00"]


def test_months_of_unclear_orders_are_left_open(spark):
    """Lines of orders that are unknown, undated or come with two months stay in every range."""
    jan, feb = datetime.date(2024, 1, 5), datetime.date(2024, 2, 5)
    orders = spark.createDataFrame(
        [("a", jan), ("b", feb), ("c", jan), ("c", feb), ("d", None), ("e", jan), ("e", None)],
        "order_id string, order_date date",
    )
    lines = spark.createDataFrame([(o, n) for o in "abcdex" for n in (1, 2)], "order_id string, line_no int")
    dated = files.with_placed_month(lines, orders)
    assert dated.count() == lines.count()
    months = {r.order_id: r.placed_month for r in dated.collect()}
    assert months == {"a": jan.replace(day=1), "b": feb.replace(day=1), "c": None, "d": None, "e": None, "x": None}
    kept = {r.order_id for r in files.in_months(dated, feb, feb).collect()}
    assert kept == {"b", "c", "d", "e", "x"}
    assert files.in_months(lines, feb, feb).count() == lines.count()


def test_stored_tables_are_forgotten_with_their_folder(spark, tmp_path):
    """After clear_scratch(), and when a source changes, queries build their tables anew."""
    import os
    import shutil

    from tillroll.plans import catalog
    from tillroll.session import clear_scratch

    folder = str(tmp_path / "tables")
    shutil.copytree("/root/testdata/sf0.001", folder)
    query = catalog.queries()["rfm_segment_counts"]
    before = texts(query(spark, folder))
    clear_scratch(spark)
    assert texts(query(spark, folder)) == before
    orders = f"{folder}/orders.parquet"
    some = spark.read.parquet(orders).filter("o_custkey % 2 = 0").toPandas()
    os.chmod(folder, 0o755)
    os.remove(orders)
    some.astype({"o_orderdate": "datetime64[us]"}).to_parquet(orders)
    spark.catalog.refreshByPath(folder)
    assert texts(query(spark, folder)) != before
