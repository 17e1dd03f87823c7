"""Range-partitioned order statistics and running totals against brute force."""

import random
from decimal import Decimal

import pandas as pd
import pytest

from tillroll.functions.ranges import SortedMetrics, running_totals
from tillroll.operators import rfm


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Keep the small ranges apart instead of letting them be merged into one."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, "true")


def base_frame(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id long, recency int, frequency long, monetary decimal(12,2)"
    )


def customers(n, seed, hot=0.0):
    """n customers; a ``hot`` share of them has the same value everywhere."""
    pick = random.Random(seed)
    return [
        (
            i * 7919 % 100_003,
            5 if pick.random() < hot else pick.randint(1, 400),
            2 if pick.random() < hot else pick.randint(1, 9),
            Decimal("9.99") if pick.random() < hot else Decimal(pick.randint(1, 10**6)) / 100,
        )
        for i in range(n)
    ]


def quarters_of(values):
    """Score of each value: how many of the three cuts, which lie at quarters of the way from the
    first place to the last, its own place is above; equal values keep their order."""
    places = sorted(range(len(values)), key=lambda i: values[i])
    steps = len(values) - 1
    score = dict(zip(places, (max(1, -(-4 * p // steps)) for p in range(len(values))), strict=True))
    return [score[i] for i in range(len(values))]


@pytest.mark.parametrize("n,hot", [(2, 0), (3, 0), (10, 0), (242, 0), (500, 0.4), (501, 0.9)])
def test_scores_match_pandas(spark, n, hot):
    rows = sorted(customers(n, seed=n, hot=hot))
    frame = pd.DataFrame(rows, columns=["customer_id", "recency", "frequency", "monetary"])
    cuts = [frame.recency.quantile(q) for q in (0.25, 0.5, 0.75)]
    wanted = list(
        zip(
            frame.customer_id,
            [4 - sum(r > c for c in cuts) for r in frame.recency],
            quarters_of(frame.frequency),
            quarters_of(frame.monetary.astype(float)),
            strict=True,
        )
    )
    scored = rfm.rfm_scores(base_frame(spark, rows).repartition(7))
    found = scored.select("customer_id", "R_score", "F_score", "M_score").orderBy("customer_id")
    assert [tuple(r) for r in found.collect()] == [tuple(int(v) for v in w) for w in wanted]


def test_one_customer_and_none(spark):
    one = rfm.rfm_segment(rfm.rfm_scores(base_frame(spark, [(1, 3, 2, Decimal("5.00"))])))
    shown = [tuple(r) for r in one.select("R_score", "F_score", "M_score", "segment").collect()]
    assert shown == [(4, 1, 1, "Potential")]
    assert rfm.rfm_segment(rfm.rfm_scores(base_frame(spark, []))).collect() == []


def test_equal_recency(spark):
    rows = [(i, 4, i, Decimal(i)) for i in range(1, 9)]
    scored = rfm.rfm_scores(base_frame(spark, rows))
    assert {r["R_score"] for r in scored.collect()} == {4}


@pytest.mark.parametrize("n", [1, 2, 5, 100])
def test_description(spark, n):
    rows = customers(n, seed=n + 1)
    frame = pd.DataFrame(rows, columns=["customer_id", "recency", "frequency", "monetary"])
    wanted = frame[["recency", "frequency", "monetary"]].astype(float).describe()
    found = {r["statistic"]: r for r in rfm.describe_metrics(base_frame(spark, rows)).collect()}
    for statistic in wanted.index:
        for metric in wanted.columns:
            value = wanted.loc[statistic, metric]
            if pd.isna(value):
                assert found[statistic][metric] is None
            else:
                assert found[statistic][metric] == pytest.approx(value, abs=0.0051)


def test_description_of_nothing(spark):
    found = {r["statistic"]: r for r in rfm.describe_metrics(base_frame(spark, [])).collect()}
    assert found["count"]["recency"] == 0 and found["50%"]["monetary"] is None


def test_ranks_span_partitions(spark):
    n = 5_000
    ordered = SortedMetrics(
        spark.range(n).selectExpr("id", "id % 3 as low", f"{n} - id as high"),
        "id",
        ["low", "high"],
    )
    assert ordered.count == n
    assert len(ordered._sizes) > 1
    by_low = sorted((i % 3, i) for i in range(n))
    ranks = [1, 2, n // 4, n // 2, n - 1, n]
    found = ordered.at({"low": ranks, "high": ranks})
    assert [(int(v), i) for v, i in found["low"]] == [by_low[r - 1] for r in ranks]
    assert [(int(v), i) for v, i in found["high"]] == [(r, n - r) for r in ranks]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_running_totals(spark, partitions):
    pick = random.Random(5)
    rows = [
        (
            None if i % 50 == 0 else 1 if i % 3 == 0 else pick.randint(1, 300),
            pick.randint(1, 30),
            i,
            None if i % 11 == 0 else Decimal(pick.randint(-500, 10_000)) / 100,
        )
        for i in range(2_000)
    ]
    frame = spark.createDataFrame(rows, "who int, day int, id long, paid decimal(12,2)")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = running_totals(frame, "who", ["day", "id"], "paid", "place", "so_far")
        got = {r["id"]: (r["place"], r["so_far"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted, place, total = {}, {}, {}
    for who, day, key, paid in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2])):
        place[who] = place.get(who, 0) + 1
        if paid is not None:
            total[who] = total.get(who, Decimal(0)) + paid
        wanted[key] = (place[who], total.get(who))
    assert got == wanted
