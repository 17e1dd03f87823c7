"""Exact nearest binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into segments, and each segment is an index.  Two codes that differ in at
most r bits of every segment searched so far are found by looking up all segment values within r
bits of the query's.  After radius r in some segments and r - 1 in the others, a code not yet seen
differs by at least the sum of (radius + 1) over the segments; as soon as the k-th smallest verified
distance is below that, the answer is complete.  The radius grows one segment at a time until then,
at the latest when it covers a whole segment.

Equal codes are one entry with its k + 1 smallest ids.  Entries are dealt into shards by hash, and
queries into blocks; a task searches one shard for one block with tables of its own, and the
answers of the shards for a query are merged.  A shard's segments are about as long as the
logarithm of its size, which keeps a look-up to a few entries.

Defined results: a vector that is null, or empty, or holds a null, has no code, answers nothing and
is never an answer; ties in distance go to the smaller id; with fewer than k others a query has
fewer answers; rows that repeat an id are answers of their own, and as a query one for each code; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import read_table
from tillroll.session import materialise

K = 10
QUERY_ONE_IN = 20
BITS = 64
SHARD_CODES = 8192
BLOCK_QUERIES = 8192
SALTS = 64
MAX_TASKS = 20_000  # partitions of the search; beyond that a task searches several shards
PROJECTION_SEED = 20
CHUNK_PAIRS = 1 << 20


@functools.cache
def _projection(dimensions: int) -> np.ndarray:
    return np.random.default_rng(PROJECTION_SEED).standard_normal((dimensions, BITS))


def codes_of(vectors: np.ndarray) -> np.ndarray:
    """Signs of up to 64 dimensions, or of 64 random projections of more, as signed longs."""
    if vectors.shape[1] > BITS:
        vectors = vectors @ _projection(vectors.shape[1])
    bits = np.zeros((len(vectors), BITS), bool)
    bits[:, : vectors.shape[1]] = vectors > 0
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def binary_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(id, code) of every vector that has one."""

    @F.pandas_udf("long")
    def encode(column: pd.Series) -> pd.Series:
        out = pd.Series(0, index=column.index, dtype="int64")
        for size, rows in column.groupby(column.map(len)):
            out[rows.index] = codes_of(np.stack(rows.to_numpy()))
        return out

    vector = F.col(vector_column)
    whole = vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull())
    return (
        vectors.filter(whole & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("id"), vector.cast("array<double>").alias("v"))
        .select("id", encode("v").alias("code"))
    )


@functools.cache
def _masks(bits: int, ones: int) -> np.ndarray:
    """All values of so many bits with so many ones."""
    return np.array(
        [sum(1 << b for b in chosen) for chosen in itertools.combinations(range(bits), ones)],
        np.int64,
    )


class MultiIndex:
    """Tables over the segments of some different codes (uint64)."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        length = min(16, max(4, round(math.log2(max(2, len(codes))))))
        count = -(-BITS // length)
        edges = [BITS * i // count for i in range(count + 1)]
        self.segments = [(low, high - low) for low, high in itertools.pairwise(edges)]
        self.order, self.starts = [], []
        for low, size in self.segments:
            values = self._segment(codes, low, size)
            self.order.append(np.argsort(values, kind="stable"))
            sizes = np.bincount(values, minlength=1 << size)
            self.starts.append(np.concatenate([[0], np.cumsum(sizes)]))

    @staticmethod
    def _segment(codes: np.ndarray, low: int, size: int) -> np.ndarray:
        return ((codes >> np.uint64(low)) & np.uint64((1 << size) - 1)).astype(np.int64)

    def _candidates(self, queries: np.ndarray, segment: int, radius: int) -> Iterator[tuple]:
        """(query, entry) pairs whose segments differ in exactly ``radius`` bits, in chunks."""
        low, size = self.segments[segment]
        values = self._segment(queries, low, size)
        masks = _masks(size, radius)
        step = max(1, CHUNK_PAIRS // max(1, len(masks)))
        for at in range(0, len(queries), step):
            probes = (values[at : at + step, None] ^ masks[None, :]).ravel()
            first = self.starts[segment][probes]
            counts = self.starts[segment][probes + 1] - first
            asking = np.arange(at, min(at + step, len(queries)))
            query = np.repeat(np.repeat(asking, len(masks)), counts)
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield query, self.order[segment][np.repeat(first, counts) + within]

    def search(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, distance): all entries up to the distance of each query's ``wanted``-th
        nearest entry, ties included."""
        wanted = min(wanted, len(self.codes))
        found = [np.empty((0, 3), np.int64)]
        held = [np.empty((0, 3), np.int64)]
        open_queries = np.arange(len(queries))
        radius_sum = 0  # of (radius + 1) over the segments
        longest = max(size for _, size in self.segments)
        for radius in range(longest + 1):
            for segment, (_, size) in enumerate(self.segments):
                radius_sum += 1
                if radius <= size:
                    for query, entry in self._candidates(queries[open_queries], segment, radius):
                        query = open_queries[query]
                        apart = np.bitwise_count(queries[query] ^ self.codes[entry])
                        held.append(np.stack([query, entry, apart.astype(np.int64)], axis=1))
                        if sum(map(len, held)) > 4 * CHUNK_PAIRS:
                            held = [self._nearest(np.concatenate(held), wanted)]
                rows = self._nearest(np.concatenate(held), wanted)
                # the k-th distance of each query that has so many verified
                counts = np.bincount(rows[:, 0], minlength=len(queries))
                last = np.full(len(queries), -1, np.int64)
                np.maximum.at(last, rows[:, 0], rows[:, 2])
                complete = (counts >= wanted) & (last < radius_sum)
                if radius == longest and segment == len(self.segments) - 1:
                    complete[:] = True
                done = complete[rows[:, 0]]
                found.append(rows[done])
                held = [rows[~done]]
                open_queries = open_queries[~complete[open_queries]]
                if len(open_queries) == 0:
                    return tuple(np.concatenate(found).T)
        return tuple(np.concatenate(found).T)

    @staticmethod
    def _nearest(rows: np.ndarray, wanted: int) -> np.ndarray:
        """For each query its different entries up to the ``wanted``-th smallest distance."""
        order = np.lexsort((rows[:, 1], rows[:, 2], rows[:, 0]))
        rows = rows[order]
        if len(rows) == 0:
            return rows
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        rows = rows[fresh]
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        sizes = np.diff(np.r_[starts, len(rows)])
        limit = rows[starts + np.minimum(sizes, wanted) - 1, 2]
        return rows[rows[:, 2] <= np.repeat(limit, sizes)]


def _entries(codes: DataFrame, keep: int) -> DataFrame:
    """(code, ids): the ``keep`` smallest ids of each code.  A batch keeps that many for each of
    its codes before anything is shuffled, then each of SALTS parts of a code does, so a code that
    many rows share stays small."""

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values("id").groupby("code", sort=False).head(keep)

    def first(ids: Column) -> Column:
        return F.slice(F.sort_array(ids), 1, keep).alias("ids")

    return (
        codes.mapInPandas(smallest, "id long, code long")
        .groupBy("code", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        .agg(first(F.collect_list("id")))
        .groupBy("code")
        .agg(first(F.flatten(F.collect_list("ids"))))
    )


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest other rows of ``codes`` (id, code)
    for each row of ``queries`` (id, code), by distance and id."""
    entries = materialise(_entries(codes, k + 1), "codes")
    asked = materialise(queries.select("id", "code").distinct(), "queries")
    shards = max(1, -(-entries.count() // SHARD_CODES))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def cell_numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    none = F.lit(None)
    by_id = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    cells = entries.select(
        F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int").alias("shard"),
        cell_numbers(blocks).alias("block"),
        none.cast("long").alias("query_id"),
        "code",
        "ids",
    ).unionAll(
        asked.select(
            cell_numbers(shards).alias("shard"),
            by_id.alias("block"),
            F.col("id").alias("query_id"),
            "code",
            none.cast("array<long>").alias("ids"),
        )
    )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        is_query = rows["ids"].isna().to_numpy()
        entry, query = rows[~is_query], rows[is_query]
        out = {"query_id": [], "code": [], "neighbour_id": [], "distance": []}
        if len(entry) == 0 or len(query) == 0:
            return pd.DataFrame(out, dtype="int64")
        index = MultiIndex(entry["code"].to_numpy(np.int64).view(np.uint64))
        asked_codes = query["code"].to_numpy(np.int64).view(np.uint64)
        different, back = np.unique(asked_codes, return_inverse=True)
        at, hit, apart = index.search(different, k + 1)
        # entries of each different code, then ids of each entry, nearest first
        order = np.argsort(at, kind="stable")
        at, hit, apart = at[order], hit[order], apart[order]
        bounds = np.searchsorted(at, np.arange(len(different) + 1))
        ids = entry["ids"].to_numpy()
        answers = []
        for i in range(len(different)):
            mine = slice(bounds[i], bounds[i + 1])
            own = [(d, n) for e, d in zip(hit[mine], apart[mine]) for n in ids[e]]
            answers.append(sorted(own)[: k + 1])
        for query_id, code, i in zip(query["query_id"].astype("int64"), query["code"], back.ravel()):
            left, skipped = k, False
            for d, n in answers[i]:
                if n == query_id and d == 0 and not skipped:
                    skipped = True  # the query itself
                elif left:
                    out["query_id"].append(query_id)
                    out["code"].append(code)
                    out["neighbour_id"].append(n)
                    out["distance"].append(d)
                    left -= 1
        return pd.DataFrame(out, dtype="int64")

    # a search takes long for its few bytes, so partitions must not be merged by their size
    tasks = min(shards * blocks, MAX_TASKS)
    answers = cells.repartition(tasks, "shard", "block").groupBy("shard", "block").applyInPandas(
        search, "query_id long, code long, neighbour_id long, distance long"
    )
    best = F.sort_array(F.collect_list(F.struct("distance", "neighbour_id")))
    merged = answers.groupBy("query_id", "code").agg(F.slice(best, 1, k).alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("place", "hit")).select(
        "query_id",
        (F.col("place") + 1).cast("long").alias("rank"),
        F.col("hit.neighbour_id").alias("neighbour_id"),
        F.col("hit.distance").alias("distance"),
    )


def op10_multi_index_search(spark: SparkSession, folder: str) -> DataFrame:
    """For every twentieth vector, the ten nearest others by the Hamming distance of sign codes."""
    codes = materialise(binary_codes(read_table(spark, folder, "embeddings")), "sign-codes")
    return nearest_codes(codes, codes.filter(F.col("id") % QUERY_ONE_IN == 0))


OP10_SQL = """
WITH signs AS (
    SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END) AS s
    FROM embeddings
), codes AS (
    SELECT vec_id, list_aggregate(s, 'string_agg', '')::BIT AS code FROM signs
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id,
           bit_count(xor(q.code, c.code))::BIGINT AS distance,
           row_number() OVER (PARTITION BY q.vec_id
                              ORDER BY bit_count(xor(q.code, c.code)), c.vec_id) AS rank
    FROM codes q JOIN codes c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
"""
