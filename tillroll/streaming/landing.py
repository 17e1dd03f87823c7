"""Files that arrive in batches, read as a stream, with a rule for what comes too late.

A landing folder holds one subfolder for each arrival and a log with a row for each: the newest
event time in it, and the time up to which its rows count as late.  That time lies ``delay``
before the newest event of all earlier arrivals, so lateness depends on the arrivals alone: not on
how many files a micro-batch takes, nor on restarts.  Spark's own watermark, with the same delay,
never runs ahead of it, and closes windows and drops join state without losing a row in time.

A landed arrival never changes.  Results go to file sinks with a checkpoint, which hold every row
exactly once however often a run is broken off and started again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillroll.session import has_path, move_path

ARRIVAL = "arrival"
LATE = "late"


@dataclass
class Landing:
    """Arrivals under ``root``; ``time`` names the event time, a timestamp."""

    spark: SparkSession
    root: str
    time: str
    delay: str
    schema: StructType | None = None

    def _log(self) -> DataFrame:
        return self.spark.read.schema(
            f"{ARRIVAL} int, newest timestamp, late_before timestamp"
        ).parquet(f"{self.root}/log")

    def add(self, rows: DataFrame, arrival: int) -> None:
        """Land the rows as one arrival; arrivals come in rising order, each once.

        A stream may run meanwhile: the rows appear all at once, after their line in the log.  An
        arrival that was broken off can be added again.
        """
        folder, staged = f"{self.root}/rows/{ARRIVAL}={arrival}", f"{self.root}/staged/{arrival}"
        if has_path(self.spark, folder):
            raise ValueError(f"arrival {arrival} has landed")
        rows.write.mode("overwrite").parquet(staged)
        landed = self.spark.read.schema(rows.schema).parquet(staged)
        times = landed.select(
            F.lit(None).cast("timestamp").alias("t0"), F.col(self.time).alias("t1")
        )
        if has_path(self.spark, f"{self.root}/log"):
            # by folder, as that of this arrival may be there from a broken-off attempt
            earlier = self._log().filter(F.col("of") < arrival)
            times = times.unionAll(earlier.select("newest", F.lit(None).cast("timestamp")))
        times.agg(F.max("t1").alias("newest"), F.max("t0").alias("before")).select(
            F.lit(arrival).alias(ARRIVAL),
            "newest",
            (F.col("before") - F.expr(f"INTERVAL {self.delay}")).alias("late_before"),
        ).write.mode("overwrite").parquet(f"{self.root}/log/of={arrival}")
        move_path(self.spark, staged, folder)
        self.schema = rows.schema

    def stream(self, **options: str) -> DataFrame:
        """All rows as a stream, with their arrival and whether they came late.  A row without an
        event time belongs to no window and is never late."""
        schema = StructType(list(self.schema.fields)).add(ARRIVAL, "integer")
        rows = self.spark.readStream.schema(schema).options(**options).parquet(f"{self.root}/rows")
        bounds = self._log().select(ARRIVAL, "late_before")  # a row for each arrival
        late = F.coalesce(F.col(self.time) <= F.col("late_before"), F.lit(False))
        return rows.join(bounds, ARRIVAL).withColumn(LATE, late).drop("late_before")

    def in_time(self, **options: str) -> DataFrame:
        """The rows that are not late, under a watermark."""
        rows = self.stream(**options).filter(~F.col(LATE)).drop(LATE)
        return rows.withWatermark(self.time, self.delay)

    def late(self) -> DataFrame:
        """The rows that are."""
        return self.stream().filter(LATE).drop(LATE)


@dataclass
class Sink:
    """The table that a stream appends to, under ``root``."""

    spark: SparkSession
    root: str
    state_rows: list[int] = field(default_factory=list)

    def advance(self, stream: DataFrame) -> StreamingQuery:
        """Process what has landed since the last call, in this process or an earlier one."""
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .option("path", f"{self.root}/table")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        for progress in query.recentProgress:
            held = [operator["numRowsTotal"] for operator in progress["stateOperators"]]
            self.state_rows.append(sum(held))
        return query

    def table(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/table")
