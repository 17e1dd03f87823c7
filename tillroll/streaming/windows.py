"""Event-time windows and joins over landed streams.

All state is bounded by the watermark: a window is held until it ends before the newest event less
the delay, a row of a join until no partner can come any more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_totals(
    stream: DataFrame,
    time: str,
    length: str,
    keys: Sequence[str],
    totals: dict[str, Column],
    slide: str | None = None,
) -> DataFrame:
    """Totals by window and keys, each window once, when it closes.  Rows are combined within a
    partition before they reach the state, so a hot key costs one row for each."""
    grouped = stream.groupBy(F.window(time, length, slide).alias("w"), *keys)
    return grouped.agg(*[total.alias(name) for name, total in totals.items()]).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *keys,
        *totals,
    )


def session_totals(
    stream: DataFrame, time: str, gap: str, keys: Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """Totals by session: rows of equal keys with at most ``gap`` between neighbours.  A session
    ends ``gap`` after its last row and comes out once, when that lies before the watermark."""
    grouped = stream.groupBy(*keys, F.session_window(time, gap).alias("s"))
    return grouped.agg(*[total.alias(name) for name, total in totals.items()]).select(
        *keys,
        F.col("s.start").alias("session_start"),
        F.col("s.end").alias("session_end"),
        *totals,
    )


def within(
    first: DataFrame,
    second: DataFrame,
    key: str,
    first_time: str,
    second_time: str,
    most: str,
    how: str = "leftOuter",
) -> DataFrame:
    """Rows of ``first`` with those of ``second`` of the same key that come at the same time or up
    to ``most`` later.  Both need a watermark.  With the outer form a row of ``first`` without any
    comes out alone once none can come; neither side is held longer than that takes."""
    other = second.withColumnRenamed(key, f"{key}_of_second")
    return first.join(
        other,
        (first[key] == other[f"{key}_of_second"])
        & (F.col(second_time) >= F.col(first_time))
        & (F.col(second_time) <= F.col(first_time) + F.expr(f"INTERVAL {most}")),
        how,
    ).drop(f"{key}_of_second")
