"""Loading and writing: CSV, typed row batches, SQL text, JDBC, Parquet."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.schemas import TABLES

RAW_LINE = "_corrupt_record"
FITS = "fits"
ORDER_MONTH = "order_month"
PLACED_MONTH = "placed_month"  # of lines and payments: the month of their order


def read_csv(
    spark: SparkSession, path: str | list[str], table: str, multi_line: bool = False
) -> DataFrame:
    """Bulk load: comma separated, ``"`` enclosed, one header line, fixed column list.

    Empty fields become NULL.  A line that does not fit the types keeps its text in
    ``_corrupt_record`` (see :func:`accepted` and :func:`rejected`).  ``multi_line`` admits line
    breaks inside quotes, at the price of reading each file in one task.
    """
    fields = [
        T.StructField(name, T.IntegerType() if isinstance(kind, T.BooleanType) else kind)
        for name, kind in TABLES[table].columns
    ]
    raw = (
        spark.read.schema(T.StructType([*fields, T.StructField(RAW_LINE, T.StringType())]))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE)
        .option("multiLine", multi_line)
        .csv(path)
    )
    return raw.select(*_typed(table), RAW_LINE)


def with_fits(loaded: DataFrame) -> DataFrame:
    """Mark the lines of a CSV load that fit the table.

    Spark converts, and so checks, only the fields a plan asks for.  The mark therefore refers to
    all of them, so that the verdict on a line is the same whatever is selected afterwards.
    """
    fields = [F.col(c).cast("string") for c in loaded.columns if c != RAW_LINE]
    misfit = F.when(F.col(RAW_LINE).isNotNull(), F.concat(RAW_LINE, F.concat_ws(",", *fields)))
    return loaded.withColumn(FITS, misfit.isNull())


def accepted(loaded: DataFrame) -> DataFrame:
    """The lines of a CSV load that fit the table."""
    return _marked(loaded).filter(F.col(FITS)).drop(FITS, RAW_LINE)


def rejected(loaded: DataFrame) -> DataFrame:
    """The quarantined lines of a CSV load, with their text."""
    return _marked(loaded).filter(~F.col(FITS)).drop(FITS)


def _marked(loaded: DataFrame) -> DataFrame:
    return loaded if FITS in loaded.columns else with_fits(loaded)


def load_rows(
    spark: SparkSession, rows: DataFrame | Sequence[Sequence[Any]], table: str
) -> DataFrame:
    """Insert a row batch: loosely typed rows in column order become typed table rows.

    Money given with more than two decimals is rounded half up, flags left out take the
    declared default.  A batch may be literal rows or a DataFrame of any size.
    """
    if not isinstance(rows, DataFrame):
        loose = T.StructType(
            [T.StructField(name, _literal_type(kind)) for name, kind in TABLES[table].columns]
        )
        rows = spark.createDataFrame([_literal_row(row, loose) for row in rows], loose)
    return rows.select(*_typed(table, with_defaults=True))


def _literal_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.BooleanType):
        return T.IntegerType()
    if isinstance(kind, T.DateType):
        return T.StringType()
    return kind


def _literal_row(row: Sequence[Any], loose: T.StructType) -> list[Any]:
    return [
        float(value) if value is not None and isinstance(f.dataType, T.DoubleType) else value
        for value, f in zip(row, loose.fields, strict=True)
    ]


def _typed(table: str, with_defaults: bool = False) -> list[Column]:
    """Casts to the table's types; key columns keep the type they arrive in if numeric."""
    spec = TABLES[table]
    columns = []
    for name, kind in spec.columns:
        value = F.col(name)
        if not (name.endswith("_id") and isinstance(kind, T.StringType)):
            value = value.cast(kind)
        if with_defaults and name in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[name]))
        columns.append(value.alias(name))
    return columns


DATE_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9:.]+(Z|[+-][0-9:]+)?)?\s*$"


def parse_dates(
    df: DataFrame,
    columns: Sequence[str],
    pattern: str | None = None,
    misfits_as: str | None = None,
) -> DataFrame:
    """Turn text columns into dates; text that is no date becomes NULL.

    Without a pattern the text is a date, or a date and a time, in ISO form, with or without
    blanks around it, and parsed by a cast, several times faster than a pattern.  ``misfits_as``
    names a column that lists, for each row, the columns whose text did not parse.
    """

    def parsed(column: str) -> Column:
        if pattern is not None:
            return F.try_to_date(column, pattern)
        day = F.regexp_extract(F.trim(column), "^[0-9]+-[0-9]+-[0-9]+", 0)
        return F.when(F.col(column).rlike(DATE_TEXT), F.try_to_date(day))

    dates = {c: parsed(c) for c in columns}
    if misfits_as is None:
        return df.withColumns(dates)
    lost = [F.when(F.col(c).isNotNull() & dates[c].isNull(), F.lit(c)) for c in columns]
    return df.withColumns({misfits_as: F.array_compact(F.array(*lost)), **dates})


def query(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame], **args: Any
) -> DataFrame:
    """Run SQL text over ``{table}`` placeholders, with ``:name`` markers bound to ``args``.

    The tables are bound for this statement only, and values never enter the text.
    """
    used = {name: frame for name, frame in tables.items() if "{" + name + "}" in text}
    return spark.sql(text, args=args or None, **used)


def read_jdbc(
    spark: SparkSession,
    url: str,
    relation: str,
    partition_column: str,
    lower: int | str,
    upper: int | str,
    num_partitions: int,
    **properties: str,
) -> DataFrame:
    """Pull a relation from an external database in ``num_partitions`` parallel ranges."""
    return (
        spark.read.format("jdbc")
        .options(**properties)
        .option("url", url)
        .option("dbtable", relation)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", num_partitions)
        .load()
    )


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Export with a header and no index column, as a folder of part files.

    Flags are written as 0 and 1, which is how :func:`read_csv` takes them.  ``compression`` is
    ``gzip``, say; a compressed part file is then read in one task.
    """
    booleans = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    flags = {name: F.col(name).cast("int") for name in booleans}
    out = df.withColumns(flags) if flags else df
    writer = out.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("compression", compression).csv(path)


def with_placed_month(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines or payments with the month of their order, null where there is none: for unknown
    orders, orders without a date, and ids that come with several months.  Rows stay as many."""
    months = orders.groupBy(F.col("order_id").alias("placed_id")).agg(
        F.min(F.trunc("order_date", "MM")).alias("low"),
        F.max(F.trunc("order_date", "MM")).alias("high"),
        F.count_if(F.col("order_date").isNull()).alias("undated"),
    )
    one = (F.col("low") == F.col("high")) & (F.col("undated") == 0)
    months = months.select("placed_id", F.when(one, F.col("low")).alias(PLACED_MONTH))
    known = rows.join(months, F.col("order_id") == F.col("placed_id"), "left")
    return known.select(*rows.columns, PLACED_MONTH)


def in_months(
    rows: DataFrame, start: datetime.date | None = None, end: datetime.date | None = None
) -> DataFrame:
    """Lines or payments that may belong to orders of a range of days: those stored with another
    month are left out, by whole folders.  Rows without a month stay, as all do that are not stored
    by month."""
    if PLACED_MONTH not in rows.columns:
        return rows
    month, kept = F.col(PLACED_MONTH), F.lit(True)
    if start is not None:
        kept &= month >= F.lit(start.replace(day=1))
    if end is not None:
        kept &= month <= F.lit(end.replace(day=1))
    return rows.filter(month.isNull() | kept)


def write_by_months(rows: DataFrame, path: str, *keys: str) -> DataFrame:
    """Store rows in a folder for each value of ``keys``, the last of which is a month, and open
    them.  They are spread by range over the keys and the order, which splits a heavy month over
    several tasks and files instead of sending it to one, and reads the input once more, as the
    bounds of the ranges are sampled first."""
    rows.repartitionByRange(*keys, "order_id").write.partitionBy(*keys).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_loaded(
    loaded: DataFrame, path: str, table: str, orders: DataFrame | None = None
) -> DataFrame:
    """Store a CSV load, fitting and quarantined lines apart, and open it.

    The result is partitioned by ``fits``.  Orders are also partitioned by month, and so are lines
    and payments, by the month of their order among the loaded ``orders``: a range of days prunes
    the files of all three.
    """
    marked = with_fits(loaded)
    if table == "orders":
        marked = marked.withColumn(ORDER_MONTH, F.trunc("order_date", "MM"))
        return write_by_months(marked, path, FITS, ORDER_MONTH)
    if orders is not None and table in ("order_items", "payments"):
        return write_by_months(with_placed_month(marked, orders), path, FITS, PLACED_MONTH)
    marked.write.partitionBy(FITS).parquet(path)
    return loaded.sparkSession.read.schema(marked.schema).parquet(path)
