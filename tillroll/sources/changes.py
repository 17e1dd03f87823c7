"""Tables that take batches of changes: a store by month, and a history of versions.

Only the folders that a batch touches are written again; all others keep their files.  What a batch
makes of them is written to the shared folder first, so that a run that is broken off can be
repeated with the same batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.session import drop_path, has_path, materialise

MONTH = "month"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # the folder name of rows without a month
BUCKET = "bucket"


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """A row for each key that is not null: of several, the greatest by columns in order."""
    greatest = rows.filter(F.col(key).isNotNull()).groupBy(key)
    whole = F.struct(*[c for c in rows.columns if c != key])
    return greatest.agg(F.max(whole).alias("of")).select(key, "of.*").select(*rows.columns)


def _replace(rows: DataFrame, path: str, folder: str, *order: str) -> None:
    """Write rows over the folders that they belong to, each spread over several files if large."""
    (
        rows.repartitionByRange(folder, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(folder)
        .parquet(path)
    )


@dataclass
class MonthStore:
    """Rows with a unique ``key``, in a folder for each month of ``date``."""

    spark: SparkSession
    path: str
    key: str
    date: str
    schema: StructType

    def table(self) -> DataFrame:
        schema = StructType(list(self.schema.fields)).add(MONTH, "date")
        if not has_path(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def apply(self, rows: DataFrame, deleted: DataFrame | None = None) -> list:
        """Add the rows, in place of those with the same keys, and delete the keys in ``deleted``;
        of a key that is in both, the row stays.  Returns the months whose folders were written
        again: those of the new rows and those where rows with their keys were."""
        month = F.trunc(self.date, "MM").alias(MONTH)
        fresh = materialise(one_per_key(rows, self.key).select("*", month), "change-batch")
        keys = fresh.select(self.key)
        if deleted is not None:
            keys = keys.unionAll(deleted.select(self.key)).distinct()
        stored = self.table()
        held = stored.select(self.key, MONTH).join(keys, self.key, "left_semi").select(MONTH)
        touched = held.unionAll(fresh.select(MONTH)).distinct()
        months = [row[MONTH] for row in touched.collect()]  # a row for each month at most
        if not months:
            return []
        in_them = F.col(MONTH).isin([m for m in months if m is not None])
        if None in months:
            in_them |= F.col(MONTH).isNull()
        kept = stored.filter(in_them).join(keys, self.key, "left_anti")
        staged = materialise(kept.select(*fresh.columns).unionAll(fresh), "change-months")
        _replace(staged, self.path, MONTH, self.key)
        left = {row[MONTH] for row in staged.select(MONTH).distinct().collect()}
        for empty in set(months) - left:
            drop_path(self.spark, f"{self.path}/{MONTH}={NO_MONTH if empty is None else empty}")
        return months


@dataclass
class History:
    """Every version of the rows with a unique ``key``, from when to when it held.

    The last version of each key lies in one of ``buckets`` folders by its key; a batch writes
    those again that it touches.  Versions that have ended lie in a folder for the batch that ended
    them and are never written again.  A deleted key stays among the last ones, marked as gone, so
    that its versions go on counting if it comes back.
    """

    spark: SparkSession
    path: str
    key: str
    schema: StructType
    buckets: int = 64

    def _current(self) -> DataFrame:
        schema = StructType(list(self.schema.fields))
        schema = schema.add("version", "integer").add("valid_from", "date").add("gone", "boolean")
        schema = schema.add(BUCKET, "integer")
        if not has_path(self.spark, f"{self.path}/current"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/current")

    def _ended(self) -> DataFrame:
        schema = StructType(list(self.schema.fields))
        schema = schema.add("version", "integer").add("valid_from", "date").add("valid_to", "date")
        if not has_path(self.spark, f"{self.path}/ended"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/ended")

    def table(self) -> DataFrame:
        """All versions; ``valid_to`` is null for those that hold."""
        holding = self._current().filter(~F.col("gone"))
        names = [*self.schema.names, "version", "valid_from", "valid_to"]
        return self._ended().select(*names).unionByName(
            holding.withColumn("valid_to", F.lit(None).cast("date")).select(*names)
        )

    def apply(
        self, rows: DataFrame, at: Column, batch: int, deleted: DataFrame | None = None
    ) -> list[int]:
        """From the day ``at`` on the rows hold, and the keys in ``deleted`` are gone; of a key in
        both, the row holds.  A row equal to the version that holds changes nothing.  Batches have
        rising numbers.  Returns the buckets written again."""
        others = [c for c in self.schema.names if c != self.key]
        fresh = one_per_key(rows.select(*self.schema.names), self.key)
        change = fresh.select(
            F.col(self.key).alias("new_key"),
            F.struct(*others).alias("new"),
            F.lit(False).alias("new_gone"),
        )
        if deleted is not None:
            gone = deleted.select(self.key).distinct().join(fresh, self.key, "left_anti")
            nothing = F.lit(None).cast(change.schema["new"].dataType)
            change = change.unionAll(gone.select(self.key, nothing, F.lit(True)))
        last = self._current()
        met = change.join(last, F.col("new_key") == F.col(self.key), "left")
        there = F.col("version").isNotNull()
        held = there & ~F.col("gone")
        same = F.struct(*others).eqNullSafe(F.col("new"))
        changes = F.when(F.col("new_gone"), held).otherwise(~held | ~same)
        met = materialise(met.filter(changes).withColumn("held", held), "history-changes")
        ended = f"{self.path}/ended/batch={batch}"
        if not has_path(self.spark, f"{ended}/_SUCCESS"):
            over = met.filter("held").withColumn("valid_to", at.cast("date"))
            names = [*self.schema.names, "version", "valid_from", "valid_to"]
            over.select(*names).write.mode("overwrite").parquet(ended)
        number = F.pmod(F.xxhash64("new_key"), F.lit(self.buckets)).cast("int")
        latest = met.select(
            F.col("new_key").alias(self.key),
            *[
                F.when(F.col("new_gone"), F.col(c)).otherwise(F.col(f"new.{c}")).alias(c)
                for c in others
            ],
            (F.coalesce("version", F.lit(0)) + F.when(F.col("new_gone"), 0).otherwise(1)).alias(
                "version"
            ),
            at.cast("date").alias("valid_from"),
            F.col("new_gone").alias("gone"),
            number.alias(BUCKET),
        ).select(*last.columns)
        touched = [row[0] for row in latest.select(BUCKET).distinct().collect()]
        if touched:
            kept = last.filter(F.col(BUCKET).isin(touched)).join(latest, self.key, "left_anti")
            staged = materialise(kept.unionAll(latest), "history-buckets")
            _replace(staged, f"{self.path}/current", BUCKET, self.key)
        return sorted(touched)
