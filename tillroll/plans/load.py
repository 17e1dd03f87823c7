"""From CSV exports to checked, typed Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import quality
from tillroll.sources import files
from tillroll.sources.schemas import TABLES, Star


@dataclass(frozen=True)
class Loaded:
    """The stored tables and what was found while loading them, all as DataFrames."""

    star: Star
    rejected: Mapping[str, DataFrame]  # lines that did not fit, by table
    row_counts: DataFrame
    repeated_keys: DataFrame
    repeated_values: DataFrame
    missing_values: DataFrame
    orphans: DataFrame


def load_star(
    spark: SparkSession,
    csv: Mapping[str, str | list[str]],
    target: str,
    expected: Mapping[str, int] | None = None,
    multi_line: bool = False,
) -> Loaded:
    """Read the five tables' CSV files, store them under ``target``, and report on the result.

    ``csv`` names the files or folders of each table.  Every table is written once, quarantined
    lines included, and the checks read the stored columns they need.  Nothing is dropped silently
    and nothing stops the load; look at the reports.  ``multi_line`` admits line breaks inside
    quotes, at the price of reading each file in one task.
    """
    stored, rejected = {}, {}
    for table in TABLES:
        parsed = files.read_csv(spark, csv[table], table, multi_line)
        written = files.write_loaded(parsed, f"{target}/{table}", table, stored.get("orders"))
        stored[table] = quality.with_defaults(files.accepted(written), table)
        rejected[table] = files.rejected(written)
    return Loaded(
        star=Star(**stored),
        rejected=rejected,
        row_counts=quality.row_counts(stored, expected),
        repeated_keys=quality.primary_keys(stored),
        repeated_values=quality.unique_columns(stored),
        missing_values=quality.not_null(stored),
        orphans=quality.foreign_keys(stored),
    )
