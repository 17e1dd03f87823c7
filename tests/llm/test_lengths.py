from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillroll.llm import lengths
from tillroll.llm.tokens import byte_pair_encoding


def plain_lengths(texts):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoding = byte_pair_encoding(str(path), pattern)
    return [len(encoding.encode_ordinary(t or "")) for t in texts]


@pytest.mark.parametrize("block", [1024, 7])
def test_every_row_and_limit_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lengths, "BLOCK", block)
    folder = "/root/testdata/sf0.001"
    known = plain_lengths([r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])
    sums = lengths.op9_length_histogram(spark, folder).cache()
    rows = {r.length: r for r in sums.collect()}
    assert {n: r.documents for n, r in rows.items()} == Counter(known)
    for n, r in rows.items():
        assert r.documents_from == sum(x >= n for x in known)
        assert r.tokens_from == sum(x for x in known if x >= n)
        assert r.truncated_tokens == sum(min(x, n) for x in known)
    limits = [0, 1, 100, 333, 2048, max(known), max(known) + 1]
    for answer in lengths.totals(sums, limits):
        limit = answer["limit"]
        assert answer == {
            "limit": limit, "documents": len(known), "tokens": sum(known),
            "documents_above": sum(x > limit for x in known),
            "truncated_tokens": sum(min(x, limit) for x in known),
        }
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    ordered = sorted(known)
    expected = [min(x for x in ordered if sum(y <= x for y in ordered) >= s * len(known)) for s in shares]
    assert lengths.quantiles(sums, shares) == expected
    sums.unpersist()


def test_odd_tables(docs):
    texts = [None, "", " " * 100_000, "a" * 30_000, "x y", "x y", "<|endoftext|>"]
    table = docs(list(enumerate(texts))).withColumn("length", F.lit(1))
    found = {r.length: r.documents for r in lengths.length_histogram(table).collect()}
    assert found == Counter(plain_lengths(texts))
    empty = lengths.with_suffix_sums(lengths.length_histogram(docs([])))
    assert empty.count() == 0 and lengths.quantiles(empty, [0.5]) == [None]
    assert lengths.totals(empty, [10])[0]["truncated_tokens"] == 0
