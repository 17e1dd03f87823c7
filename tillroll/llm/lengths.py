"""Token counts answered by an exact histogram of encoded lengths.

Every text is encoded whole, once; what is kept is how many documents have which length.  Sums over
the lengths from each one upwards then answer any context limit L exactly: documents that are
longer, all tokens, the tokens that remain when every document is cut at L, and quantiles.

The histogram has a row per different length.  Its suffix sums are taken in blocks of BLOCK lengths,
each in a group of its own, and over the totals of the blocks, so that no task holds the histogram.

Defined results: a null text counts as empty, and an empty text has length 0; repeated rows count
each; an empty table gives an empty histogram, for which every total is 0 and every quantile null.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import read_table, whole_text
from tillroll.llm.tokens import byte_pair_encoding
from tillroll.session import materialise

RANKS = "byte_bpe_50k.tiktoken"
BLOCK = 1024


def length_histogram(
    docs: DataFrame,
    ranks: str | None = None,
    pattern: str | None = None,
    text_column: str = "text",
) -> DataFrame:
    """(length, documents) for every length that occurs, in tokens of a byte-level encoding.

    ``ranks`` is the path of its file, which all executors have, and ``pattern`` its way to split
    texts; by default those of the installed public vocabularies.
    """
    import public_tokenizers

    path, split_by = str(ranks or public_tokenizers.path(RANKS)), pattern or public_tokenizers.PATTERN

    @F.pandas_udf("long")
    def encoded_length(texts: pd.Series) -> pd.Series:
        encoding = byte_pair_encoding(path, split_by)
        return texts.map(lambda text: len(encoding.encode_ordinary(text))).astype("int64")

    lengths = docs.select(encoded_length(whole_text(text_column)).alias("length"))
    return lengths.groupBy("length").agg(F.count("*").alias("documents"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """(length, documents) with, for each length that occurs: the documents and tokens of this
    length or more, and truncated_tokens, which remain if all documents are cut at this length."""
    rows = materialise(
        histogram.withColumns(
            {
                "tokens": F.col("length") * F.col("documents"),
                "block": F.expr(f"length div {BLOCK}"),
            }
        ),
        "lengths",
    )
    sums = ("documents", "tokens")
    in_block = (
        Window.partitionBy("block")
        .orderBy("length")
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    blocks = rows.groupBy("block").agg(*[F.sum(c).alias(f"block_{c}") for c in sums])
    # a row per block: longest length / BLOCK of them
    blocks = blocks.select(
        "block", *[F.coalesce(F.sum(f"block_{c}").over(later), F.lit(0)).alias(f"later_{c}") for c in sums]
    )
    joined = rows.join(blocks, "block").select(
        "length",
        "documents",
        *[(F.sum(c).over(in_block) + F.col(f"later_{c}")).alias(f"{c}_from") for c in sums],
    )
    all_tokens = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    truncated = all_tokens - F.col("tokens_from") + F.col("length") * F.col("documents_from")
    return joined.withColumn("truncated_tokens", truncated)


def totals(suffix_sums: DataFrame, limits: Sequence[int]) -> list[dict]:
    """For each context limit: documents, tokens, documents above it, tokens left when cut at it.

    One aggregation answers all limits.  The first length at or above a limit holds the suffix
    sums that it needs.
    """
    least = [F.min(F.struct("length", "documents_from", "tokens_from"))]
    at = [
        F.min(F.when(F.col("length") > limit, F.struct("length", "documents_from", "tokens_from")))
        for limit in limits
    ]
    all_rows, *found = suffix_sums.agg(
        *[c.alias(f"c{i}") for i, c in enumerate([*least, *at])]
    ).first()
    documents, tokens = (all_rows[1], all_rows[2]) if all_rows else (0, 0)
    out = []
    for limit, row in zip(limits, found, strict=True):
        longer, longer_tokens = (row[1], row[2]) if row else (0, 0)
        out.append(
            {
                "limit": limit,
                "documents": documents,
                "tokens": tokens,
                "documents_above": longer,
                "truncated_tokens": tokens - longer_tokens + limit * longer,
            }
        )
    return out


def quantiles(suffix_sums: DataFrame, shares: Sequence[float]) -> list[int | None]:
    """For each share, the smallest length that at least this share of the documents do not
    exceed."""
    documents = suffix_sums.agg(F.max("documents_from")).first()[0] or 0
    upto = documents - F.col("documents_from") + F.col("documents")
    found = suffix_sums.agg(
        *[
            F.min(F.when(upto >= F.lit(share * documents), F.col("length"))).alias(f"q{i}")
            for i, share in enumerate(shares)
        ]
    ).first()
    return list(found)


def op9_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """The histogram of all documents with its suffix sums."""
    return with_suffix_sums(length_histogram(read_table(spark, folder, "documents")))
