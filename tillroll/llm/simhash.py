"""Near-duplicates by SimHash, linked through vantage-point trees.

Fingerprints of 64 bits link at ``max_bits`` differing bits or fewer.  Two fingerprints that close
differ in at most ``max_bits // 2`` bits of one of their halves, so there is one tree for each half
and its search radius is that small.  A tree node holds a vantage point and a radius: a half lies
inside if its Hamming distance to the vantage point is at most the radius.  By the triangle
inequality a ball around a half can reach the inside only if distance - r <= radius, and the
outside only if distance + r > radius; a fingerprint is stored in its one leaf, its home, and its
ball can reach others.  As two close halves reach each other's homes, one of the two is searched for
in the other's home, and which one depends on the two leaves alone.  Leaves are shards: each is
searched by a task of its own, which prunes once more by distances to a vantage point and compares
whole fingerprints exactly.

Equal fingerprints are one point; a shard returns a star for each of its local components rather
than all its pairs.  The trees are fitted on a bounded sample, chosen by hash; the fit moves the
borders of the shards but never the result, and a shard that turns out too large is cut into
blocks of points times blocks of queries.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked
like any other; a text of fewer words than a shingle is one shingle; repeated rows get equal
values; an empty table gives no rows; a component without any id has a null component_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import free_names, hash_sample, read_table, text_hash, whole_text
from tillroll.llm.components import star_components
from tillroll.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Fingerprints a tree is fitted on, those with the smallest hash: so many, or so many for each leaf.
TREE_SAMPLE, SAMPLE_PER_LEAF = 32_768, 2
LEAF_POINTS = 1024  # aimed at; what exceeds BLOCK is cut into blocks
BLOCK = 4096
MAX_DEPTH = 18  # leaves keep their size up to 268 million different fingerprints
ROUTED_AT_ONCE = 8192
VANTAGE_TRIALS = 6
COMPARED_AT_ONCE = 1 << 21
SHINGLES_AT_ONCE = 1 << 16
HALF = np.uint64(32)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash: each bit that is set in over half of the shingles' hashes."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < shingle_words:
        shingles, count = iter([b" ".join(found)]), 1
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(shingle_words))))
        count = len(found) - shingle_words + 1
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    ones, left = np.zeros(64, np.int64), count
    while left:
        now = min(left, SHINGLES_AT_ONCE)
        block = np.fromiter(hashed, "<u8", now)
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        left -= now
    majority = np.packbits(2 * ones > count, bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, fp) of every document."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, shingle_words)).astype("int64")

    return docs.select(
        F.col(id_column).alias("doc_id"),
        text_hash(text_column).alias("text_hash"),
        simhash(whole_text(text_column)).alias("fp"),
    )


@dataclass
class VantageTree:
    """A complete binary tree over 32-bit halves; the children of node n are 2n+1 and 2n+2."""

    depth: int
    vantage: np.ndarray
    radius: np.ndarray

    @classmethod
    def fit(cls, halves: np.ndarray, depth: int, reach: int) -> VantageTree:
        inner = 2**depth - 1
        tree = cls(depth, np.zeros(inner, np.uint32), np.full(inner, 32, np.int64))
        members = {0: halves}
        for node in range(inner):
            own = members.pop(node, halves[:0])
            if len(own) == 0:
                continue
            best = None
            for point in own[:: max(1, len(own) // VANTAGE_TRIALS)][:VANTAGE_TRIALS]:
                at = np.bincount(np.bitwise_count(own ^ point), minlength=33).cumsum()
                inside = at[:32]  # for each radius 0 to 31
                reach_in = at[np.minimum(np.arange(32) + reach, 32)]
                reach_out = len(own) - np.concatenate([np.zeros(reach, int), at])[:32]
                # comparisons that a search of every member costs below this node
                cost = reach_in * inside + reach_out * (len(own) - inside)
                spot = int(cost.argmin())
                if best is None or cost[spot] < best[0]:
                    best = (cost[spot], point, spot)
            _, tree.vantage[node], tree.radius[node] = best
            is_in = np.bitwise_count(own ^ tree.vantage[node]) <= tree.radius[node]
            members[2 * node + 1], members[2 * node + 2] = own[is_in], own[~is_in]
        return tree

    def leaves(self, halves: np.ndarray) -> np.ndarray:
        """The leaf that each half lies in."""
        node = np.zeros(len(halves), np.int64)
        for _ in range(self.depth):
            apart = np.bitwise_count(halves ^ self.vantage[node])
            node = 2 * node + 1 + (apart > self.radius[node])
        return node

    def reached(self, halves: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that the ball around a half can reach."""
        row, node = np.arange(len(halves)), np.zeros(len(halves), np.int64)
        for _ in range(self.depth):
            apart = np.bitwise_count(halves[row] ^ self.vantage[node]).astype(np.int64)
            inside = apart - reach <= self.radius[node]
            outside = apart + reach > self.radius[node]
            row = np.concatenate([row[inside], row[outside]])
            node = np.concatenate([2 * node[inside] + 1, 2 * node[outside] + 2])
        return row, node


def _halves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (points >> HALF).astype(np.uint32), points.astype(np.uint32)


def shard_links(points: np.ndarray, queries: np.ndarray, max_bits: int) -> tuple:
    """(node, root) for the local components of links between ``points`` and ``queries``."""
    nodes = np.unique(np.concatenate([points, queries]))
    label = np.arange(len(nodes))
    # rings around a vantage point: a link spans max_bits rings at most
    vantage = points[0]
    ring = np.bitwise_count(points ^ vantage).astype(np.int64)
    order = np.argsort(ring, kind="stable")
    points, ring = points[order], ring[order]
    point_at = np.searchsorted(nodes, points)
    query_at = np.searchsorted(nodes, queries)
    query_ring = np.bitwise_count(queries ^ vantage).astype(np.int64)

    def root(n: int) -> int:
        while label[n] != n:
            label[n] = label[label[n]]
            n = label[n]
        return n

    for r in np.unique(query_ring):
        lo, hi = np.searchsorted(ring, [r - max_bits, r + max_bits + 1])
        mine = np.flatnonzero(query_ring == r)
        if lo == hi:
            continue
        step = max(1, COMPARED_AT_ONCE // (hi - lo))
        for start in range(0, len(mine), step):
            some = mine[start : start + step]
            near = np.bitwise_count(queries[some, None] ^ points[None, lo:hi]) <= max_bits
            i, j = np.nonzero(near)
            a, b = query_at[some[i]], point_at[lo + j]
            a, b = label[a], label[b]  # of an earlier step, so perhaps not yet roots
            apart = a != b
            if not apart.any():
                continue
            found = np.unique(np.stack([a[apart], b[apart]], axis=1), axis=0)
            for x, y in found.tolist():
                x, y = root(x), root(y)
                if x != y:
                    label[max(x, y)] = min(x, y)
            while True:  # flatten
                flat = label[label]
                if (flat == label).all():
                    break
                label = flat
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _goes(home: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Whether a half that lives in ``home`` is searched for in ``leaf``: always in its own, and for
    two leaves in one direction only, so that every leaf gets about half of what can reach it."""
    return (home == leaf) | ((home < leaf) == ((home ^ leaf) & 1 == 0))


def _routed(points: DataFrame, trees: list[VantageTree], reach: int) -> DataFrame:
    """(leaf, is_point, fp): a row for the home leaf and for each leaf to search, of either tree.
    ``leaf`` is the tree's number times 2**24 plus the node."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for number, (tree, half) in enumerate(zip(trees, _halves(fps.view(np.uint64)))):
                base = number << 24
                home = tree.leaves(half)
                yield pd.DataFrame({"leaf": base + home, "is_point": True, "fp": fps})
                row, leaf = tree.reached(half, reach)
                goes = _goes(home[row], leaf)
                row, leaf = row[goes], leaf[goes]
                yield pd.DataFrame({"leaf": base + leaf, "is_point": False, "fp": fps[row]})

    return points.mapInPandas(route, "leaf long, is_point boolean, fp long")


def fingerprint_links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all of the distinct fingerprints ``points`` (column fp) which are
    connected by pairs at ``max_bits`` differing bits or fewer."""
    reach = max_bits // 2
    count = points.count()
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, count) / LEAF_POINTS))))
    chosen = hash_sample(points, ["fp"], max(TREE_SAMPLE, SAMPLE_PER_LEAF << depth))
    sample = np.array([row["fp"] for row in chosen], np.int64).view(np.uint64)
    trees = [VantageTree.fit(half, depth, reach) for half in _halves(sample)]
    # the points are few bytes and much work, so they are spread by their number
    spread = points.repartition(max(1, -(-count // ROUTED_AT_ONCE)), "fp")
    routed = materialise(_routed(spread, trees, reach), "routed")

    # leaves above BLOCK rows: how many blocks of points, and of queries
    sizes = routed.groupBy("leaf").agg(
        F.count_if("is_point").alias("points"), F.count_if(~F.col("is_point")).alias("queries")
    )
    large = sizes.filter((F.col("points") > BLOCK) | (F.col("queries") > 4 * BLOCK)).select(
        "leaf",
        F.greatest(F.lit(1), F.ceil(F.col("points") / BLOCK)).alias("point_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("queries") / (4 * BLOCK))).alias("query_blocks"),
    )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
        is_point = rows["is_point"].to_numpy(bool)
        points, queries = np.unique(fps[is_point]), np.unique(fps[~is_point])
        if len(points) == 0 or len(queries) == 0:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        node, root = shard_links(points, queries, max_bits)
        return pd.DataFrame({"a": node.view(np.int64), "b": root.view(np.int64)})

    # every block of points meets every block of queries, in part (point block) * (query blocks) +
    # (query block); a row goes to its own block times all blocks of the other kind
    cells = routed.join(F.broadcast(large), "leaf", "left").fillna(
        1, ["point_blocks", "query_blocks"]
    )
    is_point, deep, wide = F.col("is_point"), F.col("point_blocks"), F.col("query_blocks")
    own = F.pmod(F.xxhash64("fp"), F.when(is_point, deep).otherwise(wide))
    parts = F.when(is_point, F.sequence(own * wide, own * wide + wide - 1, F.lit(1).cast("long")))
    parts = parts.otherwise(F.sequence(own, own + (deep - 1) * wide, wide))
    dealt = cells.select("leaf", "is_point", "fp", F.explode(parts).alias("part"))
    return dealt.groupBy("leaf", "part").applyInPandas(search, "a long, b long")


def simhash_components(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every document; root is the fingerprint that
    stands for its component, component_id the smallest id among the documents that links reach."""
    rows = materialise(fingerprints(docs, shingle_words, id_column, text_column), "fingerprints")
    points = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = star_components(fingerprint_links(points.select("fp"), max_bits))
    linked = points.join(roots, points.fp == roots.node).select("fp", "root", "least")
    lowest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = (
        points.join(linked.select("fp", "root"), "fp", "left")
        .join(lowest, "root", "left")
        .select(
            "fp",
            F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNull(), F.col("least"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
    )
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_per_component(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest text hash."""
    rows = simhash_components(docs, **options)
    id_column = options.get("id_column", "doc_id")
    kept = (
        rows.groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
        .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_hash").alias("kept_hash"))
    )
    (own,) = free_names(docs, "own_hash")
    hashed = docs.withColumn(own, text_hash(options.get("text_column", "text")))
    same = hashed[id_column].eqNullSafe(kept.kept_id) & (hashed[own] == kept.kept_hash)
    return (
        hashed.join(kept, same, "left_semi").dropDuplicates([id_column, own]).select(*docs.columns)
    )


def op5_simhash_vantage(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = simhash_components(read_table(spark, folder, "documents"))
    return rows.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
