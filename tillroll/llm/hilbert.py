"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised into equally filled levels, the levels of a row become one index on a
Hilbert curve, and the rows in index order are cut into runs of equal length.  Neighbours on the
curve are neighbours in every dimension, so each shard spans a small box of the metadata and a
reader that filters on any of the dimensions can skip most files by their minimum and maximum.

Defined results: a null dimension has the lowest level; a null text has no bytes and CRC 0; ties on
the curve follow the id, then size and CRC; fully equal rows take neighbouring slots; an empty
table gives no rows; further columns of the input are neither needed nor touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import numbered, read_table, whole_text
from tillroll.session import materialise

SHARDS = 16
DIMENSIONS = ("source", "lang", "n_chars")
BITS = 5


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each column of ``levels`` (dimensions x rows, values below 2**bits)."""
    x = levels.astype(np.int64).copy()
    dimensions = len(x)
    # rotate and reflect each sub-cube, from the coarsest bit down
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for i in range(dimensions):
            upper = (x[i] >> bit) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(upper, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
    # Gray code across the dimensions
    for i in range(1, dimensions):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dimensions):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def ordinal(docs: DataFrame, name: str) -> Column:
    """What a column is ordered by: a number, or its whole text."""
    column = F.col(f"`{name}`")
    kind = docs.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.nanvl(column.cast("double"), F.lit(float("inf")))
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return column.cast("timestamp").cast("double")
    return column.cast("string")


def level_cuts(
    ordinals: DataFrame, columns: Sequence[str], bits: int
) -> dict[str, list[float | str]]:
    """Lower ends of the levels above the first: what stands at equal steps of all rows in order.

    Equal values are counted, ranges of the different ones are sorted on their own and written
    once, and each range starts where the earlier ones end.  The driver gets a size per range and
    the values at the steps.  Texts are in order of code points, which is that of their bytes;
    nulls come first."""
    steps = 2**bits
    texts = {name for name, kind in ordinals.dtypes if kind == "string"}
    # every dimension has all rows, so they follow each other in one order
    entries = [
        F.struct(
            F.lit(i).alias("dim"),
            (F.lit(None) if name in texts else F.col(name)).cast("double").alias("number"),
            (F.col(name) if name in texts else F.lit(None)).cast("string").alias("word"),
        )
        for i, name in enumerate(columns)
    ]
    order = ["dim", "number", "word"]
    counted = ordinals.select(F.inline(F.array(*entries))).groupBy(*order)
    written = materialise(
        counted.agg(F.count("*").alias("held"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("slot", F.monotonically_increasing_id()),
        "levels",
    ).withColumn("part", F.shiftright("slot", 33))
    sizes = sorted(map(tuple, written.groupBy("part").agg(F.sum("held")).collect()))
    ends = list(accumulate(size for _, size in sizes))
    starts = [(part, end - size) for (part, size), end in zip(sizes, ends, strict=True)]
    total = ends[-1] // len(columns) if ends else 0

    offsets = ordinals.sparkSession.createDataFrame(starts, "part long, range_start long")
    so_far = F.sum("held").over(Window.partitionBy("part").orderBy("slot"))
    # rows of the dimension before a value and up to it; step k stands at total * k div steps
    found = (
        written.join(F.broadcast(offsets), "part")
        .withColumn("until", F.col("range_start") + so_far - F.col("dim") * total)
        .withColumn("before", F.col("until") - F.col("held"))
        .filter("before > 0")
        .filter(
            f"(before * {steps} + {total - 1}) div {max(total, 1)}"
            f" < (until * {steps} + {total - 1}) div {max(total, 1)}"
        )
        .collect()
    )
    cuts: dict[str, list[float | str]] = {name: [] for name in columns}
    for row in sorted(found, key=lambda r: (r.dim, r.before)):
        name = columns[row.dim]
        cuts[name].append(row.word if name in texts else row.number)
    return cuts


def hilbert_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    dimensions: Sequence[str] = DIMENSIONS,
    bits: int = BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row per document: id, size, text_crc32, curve, shard, slot.

    Shard sizes differ by at most one row.  Ids, sizes and levels are shuffled once, the different
    values of each dimension twice.
    """
    text = whole_text(text_column)
    names = [f"dim{i}" for i in range(len(dimensions))]
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[ordinal(docs, d).alias(n) for d, n in zip(dimensions, names, strict=True)],
    )
    cuts = level_cuts(rows.select(*names), names, bits)

    def level(name: str) -> Column:
        reached = F.filter(F.array(*[F.lit(c) for c in cuts[name]]), lambda c: c <= F.col(name))
        return (F.size(reached) if cuts[name] else F.lit(0)).alias(name)

    @F.pandas_udf("long")
    def curve(levels: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(levels.to_numpy().T, bits))

    placed = numbered(
        rows.select("doc_id", "size", "text_crc32", *[level(n) for n in names]).select(
            "doc_id", "size", "text_crc32", curve(F.struct(*names)).alias("curve")
        ),
        ["curve", "doc_id", "size", "text_crc32"],
        "hilbert",
    )
    # shard s holds the positions from ceil(s * total / shards) on
    shard = F.expr(f"(position * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("position") - first)
        .select("doc_id", "size", "text_crc32", "curve", F.col("shard").cast("int"), "slot")
    )


def write_shards(docs: DataFrame, path: str, id_column: str = "doc_id", **options) -> DataFrame:
    """Store the whole rows of ``docs`` as one folder per shard, in curve order, and return the
    stored table.  Ids must be unique here.  Rows of a shard stay in ranges of the curve, so each
    file spans a small box as well."""
    places = hilbert_shards(docs, id_column=id_column, **options).select(
        F.col("doc_id").alias("placed_id"), "shard", "slot"
    )
    clash = {"shard", "slot", "placed_id"} & set(docs.columns)
    if clash:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    joined = docs.join(places, docs[id_column].eqNullSafe(places.placed_id)).drop("placed_id")
    (
        joined.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
    return docs.sparkSession.read.parquet(path)


def op1_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards whose row counts differ by at most one."""
    return hilbert_shards(read_table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
