"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than space and the five ASCII controls from tab on.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
WORD_GAP_CHARS = " \t\n\x0b\x0c\r"


# Set where the session still has Spark's defaults, given second.
SETTINGS = {
    # split the join of a hot key whatever stands above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": ("true", "false"),
    # texts may be long: a batch that goes to Python holds fewer of them
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("500", "10000"),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder, in a session fit for long texts and hot keys."""
    for setting, (value, default) in SETTINGS.items():
        if spark.conf.get(setting) == default:
            spark.conf.set(setting, value)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text of a row, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a text without any."""
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def text_hash(column: str = "text") -> Column:
    """64 bits of a text; with the id it tells apart rows that share one of the two."""
    return F.xxhash64(F.col(column))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened as far as needed to differ from every column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def hash_sample(df: DataFrame, by: list[str], rows: int) -> list[Row]:
    """The ``rows`` rows with the smallest hash of the columns ``by``, or all if there are fewer.

    The same for the same rows, however they are partitioned.  Rows whose hash is well above are
    dropped first, so that all tasks together send the driver about twice as many as are kept.
    """
    total = df.count()
    order = F.xxhash64(*by)
    if total > 2 * rows:
        df = df.filter(order < F.lit(int(-(2**63) + 2 * rows / total * 2**64)))
    return df.orderBy(order, *by).limit(rows).collect()


def numbered(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``df`` with ``position`` (gapless from 0 in key order) and ``total``, without a global sort
    in one task: ranges of the keys are sorted on their own and written once, then each range
    adds the sizes of the earlier ones.  That small table has a row per range."""
    from tillroll.session import materialise

    written = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("range_slot", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("range_slot", 33)
    sizes = sorted(
        (r["part"], r["n"])
        for r in written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    )
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    offsets = df.sparkSession.createDataFrame(starts, "part long, range_start long")
    return (
        written.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn(
            "position",
            F.col("range_start") + F.col("range_slot") - F.shiftleft(F.col("part"), 33),
        )
        .withColumn("total", F.lit(total).cast("long"))
        .drop("part", "range_slot", "range_start")
    )


def portions(texts: list[str | None], characters: int = 8_000_000) -> Iterator[slice]:
    """Runs of texts of a bounded size together, or of a single longer one."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held > characters and i > start:
            yield slice(start, i)
            start, held = i, len(text or "")
    yield slice(start, len(texts))
