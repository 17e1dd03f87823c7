"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents that its predecessor wrote, all of them, and returns documents with
the same columns; the last returns a row per packed piece.  What a stage does with nulls, empty
texts, ties, repeated rows and empty tables is stated by its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import contextual, packing, pareto, rulelist, simhash
from tillroll.llm.common import read_table
from tillroll.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the decision list learned from the labels rejects go."""
    return rulelist.accepted(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that near-equal fingerprints link, the smallest id stays."""
    return simhash.one_per_component(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind; no document goes."""
    return contextual.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as the mix of sources takes it, from not at all to twice."""
    return pareto.resampled(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
    ("packing", packed_windows),
]

# Learned rules, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
