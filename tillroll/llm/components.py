"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialise


def _state(pairs: DataFrame) -> tuple:
    """Equal for equal sets of pairs: their count and an order-free sum of hashes."""
    return tuple(
        pairs.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
    )


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long); root is the smallest node.

    Alternates two steps until nothing changes.  In the first every node hands its larger
    neighbours the smallest node next to it; in the second every node moves its smaller neighbours
    and itself to the smallest of them.  The number of rounds grows with the logarithm of the
    longest chain.  Each round is a table in the shared folder, so a lost executor costs one round
    at most; hubs are pre-aggregated before shuffles and their join rows can be split.
    """
    pairs = materialise(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "links",
    )
    state = _state(pairs)
    while state[0]:
        ends = pairs.select(F.col("low").alias("node"), F.col("high").alias("other")).unionAll(
            pairs.select(F.col("high").alias("node"), F.col("low").alias("other"))
        )
        nearest = ends.groupBy("node").agg(F.min("other").alias("nearest"))
        nearest = nearest.select("node", F.least("node", "nearest").alias("nearest"))
        large = (
            pairs.join(nearest, pairs.low == nearest.node)
            .select("high", F.col("nearest").alias("low"))
            .distinct()
        )
        smallest = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("smallest"))
        small = (
            large.join(smallest, large.high == smallest.node)
            .select(
                F.explode(F.array("high", "low")).alias("high"),
                F.col("smallest").alias("low"),
            )
            .filter(F.col("high") != F.col("low"))
            .distinct()
        )
        pairs = materialise(small, "links")
        before, state = state, _state(pairs)
        if before == state:
            break
    roots = pairs.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(roots)
