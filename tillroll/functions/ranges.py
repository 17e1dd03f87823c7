"""Exact order statistics and running totals without a single-task sort.

Both use a range partitioning over a unique key: it stays even whatever the data looks like,
because a hot value or a hot group is itself cut into many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialise

# monotonically_increasing_id() holds the partition number above this bit and the row number
# within the partition below it.
PARTITION_BIT = 33
VALUE_TYPE = "decimal(28,2)"

Position = tuple[Decimal, Any]  # (value, id) of the row at some rank


class SortedMetrics:
    """Several numeric columns, each sorted by (value, id), addressable by rank.

    All metrics are sorted together as (metric, value, id) rows in one range shuffle.  The only
    things that reach the driver are one count per range and the rows at the requested ranks.
    """

    def __init__(self, df: DataFrame, id_column: str, metrics: Sequence[str]):
        self.metrics = sorted(metrics)
        keys = ["metric", "value", id_column]
        long_form = df.select(
            id_column, *[F.col(m).cast(VALUE_TYPE).alias(m) for m in self.metrics]
        ).unpivot([id_column], self.metrics, "metric", "value")
        self._rows = materialise(
            long_form.repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .withColumn("slot", F.monotonically_increasing_id()),
            "sorted-metrics",
        )
        self._id = id_column
        part = F.shiftright("slot", PARTITION_BIT).alias("part")
        sizes = self._rows.groupBy(part).agg(F.count("*").alias("n")).collect()
        self._sizes = sorted((row["part"], row["n"]) for row in sizes)
        self.count = sum(n for _, n in self._sizes) // len(self.metrics)

    def at(self, ranks: dict[str, Sequence[int]]) -> dict[str, list[Position]]:
        """For each metric, the (value, id) at the given 1-based ranks, in the order given."""
        wanted = {
            (metric, rank): self._slot(self.metrics.index(metric) * self.count + rank - 1)
            for metric, metric_ranks in ranks.items()
            for rank in metric_ranks
        }
        found = {
            row["slot"]: (row["value"], row[self._id])
            for row in self._rows.filter(F.col("slot").isin(sorted(set(wanted.values())))).collect()
        }
        return {m: [found[wanted[m, r]] for r in rs] for m, rs in ranks.items()}

    def quartiles(self, metric: str) -> list[Decimal]:
        """Linearly interpolated quartiles of a metric."""
        spots = [divmod(quarter * (self.count - 1), 4) for quarter in (1, 2, 3)]
        ranks = [rank for low, rest in spots for rank in (low + 1, low + 1 + (rest > 0))]
        values = [value for value, _ in self.at({metric: ranks})[metric]]
        return [
            low + (high - low) * rest / 4
            for low, high, (_, rest) in zip(values[::2], values[1::2], spots, strict=True)
        ]

    def _slot(self, position: int) -> int:
        for part, size in self._sizes:
            if position < size:
                return (part << PARTITION_BIT) + position
            position -= size
        raise IndexError(position)


def running_totals(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    amount: str,
    number_as: str,
    total_as: str,
) -> DataFrame:
    """Row number and running sum of ``amount`` within ``group``, following ``order``.

    ``(group, *order)`` must be unique.  The rows are cut into even ranges, whatever the groups'
    sizes; each range is summed on its own, and every group carries the sums of its earlier ranges
    forward.
    """
    ranged = materialise(
        df.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()),
        "running-totals",
    )
    in_range = Window.partitionBy(group, "part").orderBy(*order)
    earlier = (
        Window.partitionBy(group)
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    carried = (
        ranged.groupBy(group, "part")
        .agg(F.count("*").alias("n"), F.sum(amount).alias("s"))
        .select(
            group,
            "part",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("s").over(earlier).alias("sum_before"),
        )
    )
    local_sum = F.sum(amount).over(
        in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total_type = df.select(F.sum(amount)).schema[0].dataType
    same_range = F.col("r.part").eqNullSafe(F.col("c.part")) & F.col(f"r.{group}").eqNullSafe(
        F.col(f"c.{group}")
    )
    number = F.row_number().over(in_range)
    return (
        ranged.withColumns({"local_number": number, "local_sum": local_sum})
        .alias("r")
        .join(carried.alias("c"), same_range)
        .select(
            *[F.col(f"r.{name}") for name in df.columns],
            (F.col("local_number") + F.col("rows_before")).cast("bigint").alias(number_as),
            # NULL only while no amount has been seen, as for a plain running sum
            F.coalesce(F.col("local_sum") + F.col("sum_before"), "local_sum", "sum_before")
            .cast(total_type)
            .alias(total_as),
        )
    )


def carried_last(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    with_current: bool = True,
) -> DataFrame:
    """The last value that is not null in the rows of a group up to each row, following ``order``.

    ``values`` maps column names to the names of the results; without ``with_current`` the row
    itself does not count.  Rows that are equal in ``order`` come in an unspecified order.  The
    rows are cut into even ranges, whatever the groups' sizes.  Only the first group of a range can
    have rows in earlier ones, so what is carried over is at most one row for each range.
    """
    ranged = materialise(
        df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()),
        "carried-last",
    )
    in_range = Window.partitionBy(*group, "part").orderBy(*order)
    up_to = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow - (not with_current))
    position = F.struct(*order)
    ends = ranged.groupBy(*group, "part").agg(
        *[
            F.max_by(column, F.when(F.col(column).isNotNull(), position)).alias(column)
            for column in values
        ]
    )
    before = (
        Window.partitionBy(*group)
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    carried = ends.select(
        *[F.col(name).alias(f"g{i}") for i, name in enumerate([*group, "part"])],
        F.row_number().over(Window.partitionBy(*group).orderBy("part")).alias("nth"),
        *[F.last(column, ignorenulls=True).over(before).alias(f"c_{column}") for column in values],
    ).filter("nth > 1")
    same = F.lit(True)
    for i, name in enumerate([*group, "part"]):
        same &= F.col(name).eqNullSafe(F.col(f"g{i}"))
    local = {
        f"l_{column}": F.last(column, ignorenulls=True).over(up_to) for column in values
    }
    return (
        ranged.withColumns(local)
        .join(F.broadcast(carried), same, "left")
        .select(
            *df.columns,
            *[
                F.coalesce(f"l_{column}", f"c_{column}").alias(result)
                for column, result in values.items()
            ],
        )
    )
