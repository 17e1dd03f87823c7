import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import multiindex


def plain(codes, queries, k):
    out = []
    for at, (q, code) in enumerate(queries):
        near = sorted(((code ^ c) % 2**64).bit_count() * 10**9 + i for j, (i, c) in enumerate(codes)
                      if (i, c) != (q, code) or j != codes.index((q, code)))[:k]
        out += [(q, r + 1, x % 10**9, x // 10**9) for r, x in enumerate(near)]
    return sorted(out)


def found(spark, codes, queries, k):
    frame = spark.createDataFrame(codes, "id long, code long").repartition(4)
    asked = spark.createDataFrame(queries, "id long, code long")
    return sorted(map(tuple, multiindex.nearest_codes(frame, asked, k).collect()))


def clustered(rng, n):
    centres = [rng.getrandbits(64) for _ in range(5)]
    out = []
    for i in range(n):
        code = rng.choice(centres) if rng.random() < 0.7 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.choice((0, 0, 1, 3, 9))):
            code ^= 1 << b
        out.append((i, code - 2**64 if code >= 2**63 else code))
    return out


@pytest.mark.parametrize(("shard", "block"), [(8192, 8192), (60, 7)])
def test_answers_equal_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(multiindex, "SHARD_CODES", shard)
    monkeypatch.setattr(multiindex, "BLOCK_QUERIES", block)
    monkeypatch.setattr(multiindex, "CHUNK_PAIRS", 500)
    codes = clustered(random.Random(shard), 500)
    queries = codes[::25]
    assert found(spark, codes, queries, 10) == plain(codes, queries, 10)


def test_one_code_for_most_rows_and_few_rows(spark):
    codes = [(i, 7) for i in range(900)] + [(1000, 6), (1001, -1)]
    queries = [codes[3], codes[899], codes[900], codes[901]]
    assert found(spark, codes, queries, 4) == plain(codes, queries, 4)
    assert found(spark, codes[-2:], codes[-1:], 10) == [(1001, 1, 1000, 62)]
    assert found(spark, codes[:1], codes[:1], 3) == []
    assert found(spark, [], [], 3) == []
    twice = [(1, 5), (1, 5), (1, 6), (2, 5)]
    assert found(spark, twice, [(1, 5)], 3) == [(1, 1, 1, 0), (1, 2, 2, 0), (1, 3, 1, 2)]


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    expected = con.execute(multiindex.OP10_SQL).fetchall()
    rows = multiindex.op10_multi_index_search(spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_vectors_without_a_code(spark):
    rows = [(0, [1.0, -1.0]), (20, None), (40, []), (60, [1.0, None]), (None, [1.0, 1.0]), (1, [0.5] * 100), (2, [-3.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("x"))
    codes = {r.id: r.code for r in multiindex.binary_codes(frame).collect()}
    assert set(codes) == {0, 1, 2} and codes[0] == 1 and codes[2] == 0
    wide = np.array([[0.5] * 100])
    assert codes[1] == multiindex.codes_of(wide)[0]
