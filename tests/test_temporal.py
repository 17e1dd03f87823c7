"""Joins and groups along time against plain loops, with hot keys, ties and nulls."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tillroll.functions.ranges import carried_last
from tillroll.operators import temporal

DAY = datetime.date(2024, 1, 1)


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables in several ranges, so that values are carried over."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


@pytest.mark.parametrize("exact", [True, False])
def test_as_of_equals_a_search_per_row(spark, exact):
    rng = random.Random(1)
    # a third of the rows on each side has one key
    key = lambda: rng.choice([0, 0, 0, 1, 2, 3, None, 9])
    asked = [(i, key(), rng.choice([None, *range(40)])) for i in range(900)]
    quotes = [(key(), rng.choice([None, *range(40)]), rng.randrange(99)) for _ in range(300)]
    left = spark.createDataFrame([(i, k, day(t)) for i, k, t in asked], "id int, k int, at date")
    right = spark.createDataFrame([(k, day(t), p) for k, t, p in quotes], "k int, quoted date, price int")
    got = temporal.as_of_join(left, right, ["k"], "at", "quoted", ["price"], exact=exact)
    want = []
    for i, k, t in asked:
        found = [
            (qt, p)
            for qk, qt, p in quotes
            if None not in (k, t, qk, qt) and qk == k and (qt <= t if exact else qt < t)
        ]
        qt, p = max(found, default=(None, None))
        want.append((i, k, day(t), day(qt), p))
    assert got.columns == ["id", "k", "at", "quoted", "price"]
    assert ordered(got.collect()) == ordered(want)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_as_of_without_rows(spark):
    left = spark.createDataFrame([(1, 1, DAY)], "id int, k int, at date")
    right = spark.createDataFrame([], "k int, quoted date, price int")
    args = (["k"], "at", "quoted", ["price"])
    assert ordered(temporal.as_of_join(left, right, *args).collect()) == [(1, 1, DAY, None, None)]
    assert temporal.as_of_join(left.filter("false"), right, *args).collect() == []


def test_as_of_takes_the_same_names_on_both_sides(spark):
    table = spark.createDataFrame([(1, DAY, 5), (1, day(3), 7), (2, DAY, 1)], "k int, at date, price int")
    got = temporal.as_of_join(table, table, ["k"], "at", "at", ["price"], prefix="last_", exact=False)
    assert ordered(got.collect()) == ordered(
        [(1, DAY, 5, None, None), (1, day(3), 7, DAY, 5), (2, DAY, 1, None, None)]
    )


def test_a_hot_key_is_cut_into_ranges(spark):
    hot = spark.range(20_000).select(F.lit(7).alias("k"), F.col("id").alias("t"), (F.col("id") % 5).alias("v"))
    valued = hot.withColumn("v", F.when(F.col("t") % 1000 == 0, F.col("t")))
    got = carried_last(valued.repartition(8), ["k"], ["t"], {"v": "last"})
    assert got.filter(F.col("last") != F.col("t") - F.col("t") % 1000).count() == 0
    assert got.count() == 20_000
    spread = valued.repartitionByRange("k", "t").groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 10_000


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(2)

    def periods(n):
        out = []
        for i in range(n):
            start = rng.choice([None, *range(-300, 300)])
            length = rng.choice([-2, 0, 0, 1, 3, 4, 15, 16, 17, 400, None])
            out.append((i, rng.choice("abb"), start, None if None in (start, length) else start + length))
        return out

    one, two = periods(150), periods(170)
    left = spark.createDataFrame([(i, k, day(s), day(e)) for i, k, s, e in one], "i int, k string, s1 date, e1 date")
    right = spark.createDataFrame([(i, k, day(s), day(e)) for i, k, s, e in two], "j int, k string, s2 date, e2 date")

    def whole(p):
        return None not in p and p[2] <= p[3]

    meet = [
        (a, b) for a in one for b in two if whole(a) and whole(b) and a[2] <= b[3] and b[2] <= a[3]
    ]
    got = temporal.overlap_join(left, right, ("s1", "e1"), ("s2", "e2"), ["k"])
    assert set(got.columns) == {"k", "i", "s1", "e1", "j", "s2", "e2"}
    assert ordered(got.select("i", "j").collect()) == ordered((a[0], b[0]) for a, b in meet if a[1] == b[1])
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    unkeyed = temporal.overlap_join(left.drop("k"), right.drop("k"), ("s1", "e1"), ("s2", "e2"))
    assert ordered(unkeyed.select("i", "j").collect()) == ordered((a[0], b[0]) for a, b in meet)
    none = temporal.overlap_join(left.filter("false"), right, ("s1", "e1"), ("s2", "e2"), ["k"])
    assert none.collect() == []


def test_sessions_with_ties_and_exact_gaps(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(0, 4000, 10)])) for _ in range(600)]
    start = datetime.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(u, None if t is None else start + datetime.timedelta(seconds=t)) for u, t in rows],
        "user_id int, ts timestamp",
    )
    got = temporal.sessions(events, ["user_id"], "ts", 20, {"events": F.count("*")})
    want = []
    for user in (1, 2, None):
        times = sorted(t for u, t in rows if u == user and t is not None)
        session = []
        for t in times:
            if session and t - session[-1] > 20:
                want.append((user, session[0], session[-1] + 20, len(session)))
                session = []
            session.append(t)
        want.append((user, session[0], session[-1] + 20, len(session)))
    seconds = [
        (r.user_id, int((r.session_start - start).total_seconds()),
         int((r.session_end - start).total_seconds()), r.events)
        for r in got.collect()
    ]
    assert ordered(seconds) == ordered(want)
    assert temporal.sessions(events.filter("false"), ["user_id"], "ts", 20, {"n": F.count("*")}).collect() == []
