"""Rounding against exact fractions."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.numeric import percentage, quotient

PAIRS = st.lists(
    st.tuples(st.integers(-(10**12), 10**12), st.integers(0, 10**6)), min_size=1, max_size=50
)


def exact(numerator, denominator):
    if denominator == 0:
        return None
    share = Fraction(numerator) / denominator * 100
    whole = int(abs(share) + Fraction(1, 2))
    return Decimal(whole if share >= 0 else -whole) / 100


@settings(max_examples=15, deadline=None)
@given(PAIRS)
def test_quotient(spark, pairs):
    frame = spark.createDataFrame(pairs, "n long, d long")
    found = frame.select("n", "d", quotient(F.col("n"), F.col("d")).alias("q")).collect()
    assert [r["q"] for r in found] == [exact(r["n"], r["d"]) for r in found]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), min_size=1, max_size=50))
def test_quotient_of_money(spark, pairs):
    rows = [(Decimal(n) / 100, d) for n, d in pairs]
    frame = spark.createDataFrame(rows, "n decimal(22,2), d long")
    found = frame.select("n", "d", quotient(F.col("n"), F.col("d")).alias("q")).collect()
    assert [r["q"] for r in found] == [exact(Fraction(r["n"]), r["d"]) for r in found]


def test_halves_round_up(spark):
    frame = spark.createDataFrame([(1, 800), (1, 8), (0, 5), (5, 0)], "part long, whole long")
    found = frame.select(percentage(F.col("part"), F.col("whole")).alias("p")).collect()
    cent = Decimal("0.01")
    assert [r["p"] for r in found] == [
        Decimal("0.125").quantize(cent, ROUND_HALF_UP),
        Decimal("12.50"),
        Decimal("0.00"),
        None,
    ]


def test_ratios_of_the_largest_sums(spark):
    row = spark.sql("select 1000000000000000000 as total, 3 as n, 922337203685477580 as many")
    found = row.select(
        quotient(F.col("total"), F.col("many")).alias("a"),
        percentage(F.col("many"), F.col("total")).alias("b"),
        quotient(F.col("total").cast("decimal(28,2)"), F.col("n") * 1000).alias("c"),
    ).first()
    assert [str(v) for v in found] == ["1.08", "92.23", "333333333333333.33"]
