"""Recency, frequency and monetary scoring of customers."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import quotient
from tillroll.functions.ranges import VALUE_TYPE, Position, SortedMetrics
from tillroll.operators.revenue import REALISED, fact_orders, order_totals
from tillroll.session import materialise

METRICS = ("recency", "frequency", "monetary")
QUARTERS = [0.25, 0.5, 0.75]

# Lowest total score of each segment, best first, and the rest.
SEGMENTS = ((10, "Champions"), (8, "Loyal"), (5, "Potential"))
LOWEST_SEGMENT = "At-Risk"


def rfm_base(
    orders: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Last order, orders, spend and recency of every customer with a delivered, paid order in
    the fact table.

    Recency counts from the day after the newest such order.  Orders are chosen by semi joins, so
    no amount is ever repeated per line; customers are tested once orders are summed.

    The customer rows are written to the shared folder once: the newest date, and all that
    follows from this table, then reads them instead of joining orders and payments again.
    """
    realised = orders.filter(F.col("order_status").isin(*REALISED))
    present = fact_orders(realised, payments, order_items, products, None)
    per_customer = (
        order_totals(present, payments, "customer_id", "order_date")
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order"),
            F.count_distinct("order_id").alias("frequency"),
            F.coalesce(F.sum("grand_total"), F.lit(0)).alias("monetary"),
        )
        .join(customers.select("customer_id"), "customer_id", "left_semi")
    )
    stored = materialise(per_customer, "rfm-base")
    newest = stored.agg(F.max("last_order")).scalar()
    return stored.withColumn("recency", F.datediff(F.date_add(newest, 1), "last_order"))


def _rank_score(metric: str, cuts: list[Position]) -> Column:
    """1 plus the number of cut rows that sort before this row by (value, customer)."""
    value = F.col(metric).cast(VALUE_TYPE)
    score = F.lit(1)
    for cut_value, cut_id in cuts:
        at = F.lit(cut_value).cast(VALUE_TYPE)
        score = score + F.when(
            (value > at) | ((value == at) & (F.col("customer_id") > F.lit(cut_id))), 1
        ).otherwise(0)
    return score


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quartile scores and the segment of every row of :func:`rfm_base`.

    Recency is binned at its interpolated quartiles.  Frequency and monetary value are binned at
    the quartiles of their rank, where ties rank by customer id: the three rows at ranks
    1 + j * (n - 1) / 4 decide every score, so only those rows are looked up and no rank is
    computed for anyone else.
    """
    ordered = SortedMetrics(base, "customer_id", ["frequency", "monetary"])
    n = ordered.count
    ranks = [quarter * (n - 1) // 4 + 1 for quarter in (1, 2, 3)] if n else []
    ranked = ordered.at({"frequency": ranks, "monetary": ranks})
    # one counter per different value: recency has no more of them than the calendar has days
    cuts = base.agg(F.percentile("recency", F.lit(QUARTERS)))
    return (
        base.withColumn("cuts", cuts.scalar())
        .withColumns(
            {
                # 4 for the most recent quarter down to 1; equal recency, equal score
                "R_score": 4
                - F.size(F.filter(F.col("cuts"), lambda cut: cut < F.col("recency"))).cast("int"),
                "F_score": _rank_score("frequency", ranked["frequency"]),
                "M_score": _rank_score("monetary", ranked["monetary"]),
            }
        )
        .withColumn("RFM_score", F.col("R_score") + F.col("F_score") + F.col("M_score"))
        .drop("cuts")
    )


def rfm_segment(scores: DataFrame) -> DataFrame:
    """Add the segment to scored customers."""
    segment = F.lit(LOWEST_SEGMENT)
    for least, name in reversed(SEGMENTS):
        segment = F.when(F.col("RFM_score") >= least, name).otherwise(segment)
    return scores.withColumn("segment", segment)


def rfm_segment_summary(segmented: DataFrame) -> DataFrame:
    """Customers, mean spend and mean orders per segment, largest first."""
    return (
        segmented.groupBy("segment")
        .agg(
            F.count("customer_id").alias("customers"),
            quotient(F.sum("monetary"), F.count("monetary")).alias("avg_revenue"),
            quotient(F.sum("frequency"), F.count("frequency")).alias("avg_orders"),
        )
        .orderBy(F.desc("customers"), "segment")
    )


def rfm_segment_counts(segmented: DataFrame) -> DataFrame:
    """Customers per segment, largest first."""
    return (
        segmented.groupBy("segment")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "segment")
    )


def describe_metrics(base: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the three metrics, one row per statistic.

    Quartiles are exact and interpolated.  Those of recency and frequency come from the
    percentile aggregate, which keeps one counter per different value: no more than there are
    days, or than the square root of twice the orders.  Spend may differ for every customer, so
    its quartiles are looked up in a range sort instead.
    """
    spend = SortedMetrics(base, "customer_id", ["monetary"])
    spend_quartiles = spend.quartiles("monetary") if spend.count else [None] * 3

    def quartile(metric: str, place: int) -> Column:
        if metric != "monetary":
            return F.percentile(metric, QUARTERS[place])
        value = spend_quartiles[place]
        cent = value and value.quantize(Decimal("0.01"), ROUND_HALF_UP)
        return F.lit(cent).cast("double")

    statistics = {
        "count": lambda m: F.count(m).cast("double"),
        "mean": lambda m: quotient(F.sum(m), F.count(m)).cast("double"),
        "std": lambda m: F.round(F.stddev_samp(F.col(m).cast("double")), 2),
        "min": lambda m: F.min(m).cast("double"),
        "25%": lambda m: quartile(m, 0),
        "50%": lambda m: quartile(m, 1),
        "75%": lambda m: quartile(m, 2),
        "max": lambda m: F.max(m).cast("double"),
    }
    row = base.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("statistic"), *[stat(m).alias(m) for m in METRICS])
                for name, stat in statistics.items()
            ]
        ).alias("rows")
    )
    return row.select(F.inline("rows"))
