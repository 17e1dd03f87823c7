"""Data-quality operators: the constraints a database would enforce, as queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.schemas import TABLES


def duplicates(df: DataFrame, keys: Sequence[str], count_as: str = "count") -> DataFrame:
    """Key values held by more than one row; rows with a NULL in the key are not compared."""
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(present)
        .groupBy(*keys)
        .agg(F.count("*").alias(count_as))
        .filter(F.col(count_as) > 1)
    )


def repeated_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Key violations of several tables: one row per repeated key."""
    return _stacked(
        duplicates(tables[table], columns, "row_count").select(
            F.lit(table).alias("table_name"),
            F.lit(",".join(columns)).alias("key_columns"),
            F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("key_value"),
            "row_count",
        )
        for table, columns in keys.items()
    )


def primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated primary keys, single and composite."""
    return repeated_keys(tables, {t: TABLES[t].primary_key for t in tables})


def unique_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated values of columns declared unique."""
    return _stacked(
        repeated_keys(tables, {t: (column,)}) for t in tables for column in TABLES[t].unique
    )


def not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs in every required column, one pass over each table."""
    return _stacked(
        null_counts(df.select(*TABLES[t].not_null)).select(
            F.lit(t).alias("table_name"), "column_name", "null_count"
        )
        for t, df in tables.items()
    )


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str, unique_parent: bool = True
) -> DataFrame:
    """Child key values without a parent, and how many rows hold each.

    Child keys are counted before the anti join, so a key held by many rows crosses the shuffle
    as one row per task; so do parent keys that may repeat.  A NULL key refers to nothing and is
    valid.
    """
    held = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("missing_key"))
        .agg(F.count("*").alias("row_count"))
    )
    known = parent.select(F.col(parent_key).alias("known_key"))
    if not unique_parent:
        known = known.distinct()
    return held.join(known, held["missing_key"] == known["known_key"], "left_anti")


def foreign_keys(
    tables: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str]] | None = None
) -> DataFrame:
    """Orphans of every reference, as (table, column, parent table); all declared ones if not given.

    The parent's column has the same name as the child's.
    """
    if relations is None:
        relations = [(t, c, parent) for t in tables for c, parent in TABLES[t].references]
    return _stacked(
        orphans(
            tables[t],
            column,
            tables[parent],
            column,
            unique_parent=TABLES[parent].primary_key == (column,),
        ).select(
            F.lit(t).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent).alias("parent_table"),
            F.col("missing_key").cast("string").alias("missing_key"),
            "row_count",
        )
        for t, column, parent in relations
    )


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill flags left out with their declared default."""
    filled = {
        column: F.coalesce(F.col(column), F.lit(default))
        for column, default in TABLES[table].defaults.items()
        if column in df.columns
    }
    return df.withColumns(filled)


def default_usage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per flag value after defaulting: rows, and how many of them took the default."""
    parts = []
    for table, df in tables.items():
        for column in TABLES[table].defaults:
            missing = df.select(column, F.col(column).isNull().alias("missing"))
            filled = with_defaults(missing, table)
            parts.append(
                filled.groupBy(F.col(column).alias("flag_value"))
                .agg(
                    F.count("*").alias("row_count"), F.count_if("missing").alias("defaulted_rows")
                )
                .select(
                    F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    "flag_value",
                    "row_count",
                    "defaulted_rows",
                )
            )
    return _stacked(parts)


def status_null_audit(orders: DataFrame) -> DataFrame:
    """Per order status: all orders, and those without and with a delivery date."""
    missing = F.col("delivered_date").isNull()
    return (
        orders.groupBy("order_status")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_if(missing).alias("null_delivered_date"),
            F.count("delivered_date").alias("has_delivered_date"),
        )
        .orderBy("order_status")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column_name", "null_count"
    )


def null_summary(df: DataFrame) -> DataFrame:
    """Columns that contain NULLs."""
    return null_counts(df).filter(F.col("null_count") > 0)


def preview(
    df: DataFrame,
    rows: int,
    order: Sequence[str],
    complete: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """First rows in ``order``, together with the table's row and column count.

    ``complete`` attaches costly columns to the chosen rows, so that ``df`` need not have them.
    """
    total = df.agg(F.count("*").alias("row_count"))
    first = df.orderBy(*order).limit(rows)
    shown = first if complete is None else complete(first)
    return shown.withColumns(
        {"row_count": total.scalar(), "column_count": F.lit(len(shown.columns))}
    )


def row_counts(
    tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows per table; with ``expected`` also the wanted number and whether it is met."""
    counts = _stacked(
        df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t, df in tables.items()
    )
    if expected is None:
        return counts
    wanted = F.lit(None).cast("bigint")
    for table, n in expected.items():
        wanted = F.when(F.col("table_name") == table, F.lit(n).cast("bigint")).otherwise(wanted)
    return counts.withColumn("expected", wanted).withColumn(
        "as_expected", F.col("row_count") == F.col("expected")
    )


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The typed definition of each table next to what it holds: one row per column."""
    parts = []
    for table, df in tables.items():
        declared = {name: kind.simpleString() for name, kind in TABLES[table].columns}
        filled = df.agg(*[F.count(c).alias(c) for c in declared]).unpivot(
            [], list(declared), "column_name", "filled_rows"
        )
        kinds = F.create_map(*[F.lit(x) for pair in declared.items() for x in pair])
        places = F.create_map(*[F.lit(x) for i, c in enumerate(declared, 1) for x in (c, i)])
        parts.append(
            filled.select(
                F.lit(table).alias("table_name"),
                places[F.col("column_name")].alias("position"),
                "column_name",
                kinds[F.col("column_name")].alias("column_type"),
                "filled_rows",
            )
        )
    return _stacked(parts)


def _stacked(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
