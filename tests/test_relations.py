"""Load differences, hierarchies, own-group conditions, JSON and sketches on awkward rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import relations, summaries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_differences_are_those_of_multisets(spark):
    rng = random.Random(8)

    def load():
        return [(rng.randrange(40), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for _ in range(300)]

    one, two = load(), load()
    one += [(99, "hot", 1)] * 5000
    two += [(99, "hot", 1)] * 4999
    frames = [spark.createDataFrame(rows, "id int, a string, b int") for rows in (one, two)]
    first, second = Counter(one) - Counter(two), Counter(two) - Counter(one)
    want = []
    for key in {r[0] for r in [*first, *second]}:
        a = list(Counter({r: n for r, n in first.items() if r[0] == key}).elements())
        b = list(Counter({r: n for r, n in second.items() if r[0] == key}).elements())
        names = None
        if len(a) == len(b) == 1:
            names = ",".join(n for n, x, y in zip("ab", a[0][1:], b[0][1:]) if x != y)
        want.append((key, len(a), len(b), names))
    assert ordered(relations.reconciled(*frames, "id")) == sorted(want, key=str)
    assert relations.reconciled(frames[0], frames[0], "id").count() == 0


def test_a_deep_hierarchy(spark):
    # a chain of eleven with a bush below each node
    edges = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(11)]
    edges += [(f"n{i}b{k}", f"n{i}") for i in range(11) for k in range(2)]
    table = spark.createDataFrame(edges, "node string, parent string")
    parent = dict(edges)
    want = []
    for node in parent:
        above, distance = node, 0
        while above is not None:
            want.append((node, above, distance))
            above, distance = parent[above], distance + 1
    assert ordered(relations.ancestors(table)) == sorted(want, key=str)
    amounts = spark.createDataFrame([(n, 1) for n in parent] + [("stranger", 5)], "node string, v int")
    totals = dict(ordered(relations.rolled_up(table, amounts, ["v"])))
    assert totals["n0"] == len(parent) and totals["n10"] == 3 and "stranger" not in totals


def test_hierarchies_that_are_none(spark):
    two = spark.createDataFrame([("a", "b"), ("a", "c")], "node string, parent string")
    with pytest.raises(ValueError, match="several parents"):
        relations.ancestors(two)
    circle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "node string, parent string")
    with pytest.raises(ValueError, match="above itself"):
        relations.ancestors(circle)
    assert relations.ancestors(two.filter("false")).count() == 0


def test_not_exists_and_not_in_differ_by_nulls(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some = spark.createDataFrame([(2,), (2,)], "k int")
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert ordered(relations.without(rows, some, "k")) == [(1,), (None,)]
    assert ordered(relations.without(rows, with_null, "k")) == [(1,), (None,)]
    assert ordered(relations.without(rows, some, "k", null_aware=True)) == [(1,)]
    assert ordered(relations.without(rows, with_null, "k", null_aware=True)) == []
    assert ordered(relations.without(rows, some.filter("false"), "k", null_aware=True)) == ordered(rows)
    for aware in (False, True):
        assert "NestedLoop" not in plan(relations.without(rows, some, "k", null_aware=aware))


def test_last_above_own_mean(spark):
    rows = [(1, 1, 5), (1, 2, 7), (2, 1, 9), (2, 2, 3), (3, 1, 4), (None, 1, 5), (None, 2, 9), (4, 1, 2), (4, 2, None)]
    table = spark.createDataFrame(rows, "g int, t int, amount int")
    found = relations.last_above_own_mean(table, "g", ["t"], "amount")
    assert ordered(found) == [(1, 7, 2)] and "NestedLoop" not in plan(found)


def test_json_is_shredded_by_its_merged_schema(spark):
    texts = ['{"a": 1}', '{"a": 2.5, "b": "x"}', '{"b": null, "c": {"d": true}}', '{"a"', "[1]", "7", "null", "", None, "{}"]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, sent string")
    good, misfits = relations.shredded(table, "sent", ["id"])
    assert good.columns == ["id", "a", "b", "c"]
    got = {r.id: (None if r.a is None else float(r.a), r.b, r.c and r.c.d) for r in good.collect()}
    assert got == {0: (1.0, None, None), 1: (2.5, "x", None), 2: (None, None, True), 8: (None, None, None),
                   9: (None, None, None)}
    assert sorted(r.id for r in misfits.collect()) == [3, 4, 5, 6, 7]
    good, misfits = relations.shredded(table.filter("id = 3"), "sent", ["id"])
    assert good.columns == ["id"] and good.count() == 0 and misfits.count() == 1


def test_merged_sketches_equal_those_of_the_whole(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 12).cast("int").alias("month"), (F.col("id") * 7 % 30_011).alias("who"),
        ((F.col("id") * 7919) % 200_000).cast("decimal(12,2)").alias("amount"),
    )
    stored = summaries.sketched(rows, "month", "who", "amount")
    year = summaries.merged(stored, F.lit(1), "year").select(
        "rows", summaries.distinct_estimate().alias("who"),
        *[summaries.quantile_estimate(q).alias(f"q{int(100 * q)}") for q in (0.1, 0.5, 0.9)],
    ).first()
    whole = summaries.sketched(rows.withColumn("month", F.lit(1)), "month", "who", "amount").select(
        summaries.distinct_estimate().alias("who")
    ).first()
    assert year.rows == 200_000 and year.who == whole.who
    assert abs(year.who - 30_011) < 4 * 1.04 / 64 * 30_011
    for q in (10, 50, 90):
        assert abs(year[f"q{q}"] / 200_000 - q / 100) < 0.03


def test_the_cube_expands_cells_not_lines(spark):
    orders = spark.createDataFrame([(i, f"s{i % 3}", f"{2020 + i % 2}-01-01") for i in range(50)],
                                   "order_id int, ship_state string, d string")
    orders = orders.select("order_id", "ship_state", F.to_date("d").alias("order_date"))
    lines = spark.range(5000).select(
        (F.col("id") % 50).cast("int").alias("order_id"), (F.col("id") % 7).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit("2.50").cast("decimal(10,2)").alias("unit_price"))
    products = spark.range(7).select(F.col("id").alias("product_id"), F.concat(F.lit("c"), F.col("id") % 2).alias("category"))
    cube = summaries.sales_cube(orders, lines, products)
    top = cube.filter("all_ship_state + all_category + all_year = 3").collect()
    assert [(r.orders, float(r.revenue)) for r in top] == [(50, 12500.0)]
    by_category = {r.category: r.orders for r in cube.filter("all_ship_state + all_year = 2 AND all_category = 0").collect()}
    assert by_category == {"c0": 50, "c1": 50}
    # every Expand reads what an aggregate has made
    text = plan(cube)
    assert "Expand" in text and text.index("Expand") < text.index("HashAggregate", text.index("Expand"))
