"""Near-duplicates by MinHash, with odd sketches between the bands and the full sets.

A document is its set of different shingles, as 64-bit hashes.  SAMPLES minima of random linear
maps sample the set.  The first BANDS * ROWS of them make banded buckets, where documents of
similarity 0.85 miss each other once in 10 ** 8.  All of them fold into an odd sketch: each sample
flips one of BITS bits, so that the XOR of two sketches has as many ones as a set of the samples
that differ leaves, and with c ones the similarity is about 1 + BITS / (4 SAMPLES) * ln(1 - 2 c /
BITS).  Its standard deviation at 0.85 is 0.024; a pair goes on if the estimate is within six of
them.  What goes on is confirmed on full sets, exactly.

Equal sets are one node.  Pairs are never listed within a bucket:

1. Every member of a bucket is held against its smallest member, by sketch and then by full set.
   That joins most of a group of copies, however large.
2. Buckets whose members are still apart are searched in blocks for sketches close enough; a block
   returns a forest over the components found so far, which gives groups of components that may be
   linked.  Buckets with equal members are searched once.
3. In each such group, the nodes outside its largest component are held against all of its nodes,
   in blocks of bounded bytes, by sketch and then by full set; a block returns a forest again.

A link is therefore lost only if the bands or the sketch miss it.  Full sets are not stored for all
documents: those in shared buckets are computed again.

Defined results: shingles are of lower-cased (A-Z) words; a text of fewer words than a shingle is
one shingle; a null text or one without words has the empty set and is a component of its own;
repeated rows get equal values; a component without any id has a null component_id, and kept means
that doc_id and component_id are the same, also both null; an empty table gives no rows.  Further
columns are left out.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import portions, read_table, text_hash, whole_text
from tillroll.llm.components import star_components
from tillroll.session import materialise

SHINGLE_WORDS = 5
PERCENT = 85
BANDS, ROWS = 32, 5
SAMPLES = 256
BITS = 1024
DEVIATIONS = 6
SEED = 42
BLOCK = 2048  # sketches of a bucket that are compared with as many others in one task
BLOCK_BYTES = 2 << 20  # of full sets
COMPARED_AT_ONCE = 1 << 21
SAMPLED_AT_ONCE = 2048
HEAVY = 1000  # sets that more than one row in so many has are labelled by broadcast


def _mixed(z: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit given."""
    z = z ^ (z >> np.uint64(32))
    z = z * np.uint64(0xD6E8FEB86659FD93)
    z = z ^ (z >> np.uint64(29))
    z = z * np.uint64(0xA0761D6478BD642F)
    return z ^ (z >> np.uint64(32))


def _word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits of each word, eight bytes at a time; ``data`` goes on for eight bytes at least."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    hashes = _mixed(lengths.astype(np.uint64))
    left, at = np.arange(len(starts)), 0
    while len(left):
        rest = lengths[left] - at
        chunk = eight[starts[left] + at]
        unused = np.uint64(8) * np.maximum(8 - rest, 0).astype(np.uint64)
        chunk = (chunk << unused) >> unused
        hashes[left] = _mixed(hashes[left] * np.uint64(0x9E3779B97F4A7C15) + chunk)
        at += 8
        left = left[rest > 8]
    return hashes


def shingle_sets(texts: list[str | None], shingle_words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The different shingle hashes of each text, rising."""
    encoded = [(text or "").encode("utf-8", "replace") for text in texts]
    data = np.frombuffer(b"\n".join([*encoded, bytes(8)]), np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    begins = np.cumsum([0] + [len(e) + 1 for e in encoded])
    body = data[: begins[-1]]
    inside = (body != 32) & ((body < 9) | (body > 13))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    hashes = _word_hashes(data, starts, lengths)
    bounds = np.searchsorted(starts, begins)
    # of windows of words wherever they start; those over the end of a text are not taken
    count = max(len(hashes) - shingle_words + 1, 0)
    windows = hashes[:count].copy()
    for k in range(1, shingle_words):
        windows = _mixed(windows * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + count])
    out = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if last - first >= shingle_words:
            out.append(np.unique(windows[first : last - shingle_words + 1]))
        elif last > first:
            whole = xxhash.xxh64_intdigest(hashes[first:last].tobytes(), SEED)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


@functools.cache
def _maps() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors, random.integers(0, 2**32, SAMPLES, dtype=np.uint32)


def samples(shingles: np.ndarray) -> np.ndarray:
    """SAMPLES minima of a set that is not empty."""
    factors, shifts = _maps()
    least = None
    for start in range(0, len(shingles), SAMPLED_AT_ONCE):
        some = (shingles[start : start + SAMPLED_AT_ONCE] >> np.uint64(32)).astype(np.uint32)
        found = (some[:, None] * factors + shifts).min(axis=0)
        least = found if least is None else np.minimum(least, found)
    return least


def buckets_and_sketches(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of minima: a 64-bit bucket for each band, and the sketch as 64-bit words."""
    wide = minima.astype(np.uint64)
    buckets = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(minima), BANDS))
    for row in range(ROWS):
        banded = wide[:, row : BANDS * ROWS : ROWS]
        buckets = _mixed(buckets * np.uint64(0x9E3779B97F4A7C15) + banded)
    number = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
    places = (_mixed(wide | number) % np.uint64(BITS)).astype(np.int64)
    flat = (places + BITS * np.arange(len(minima))[:, None]).ravel()
    odd = np.bincount(flat, minlength=BITS * len(minima)).reshape(-1, BITS) & 1
    packed = np.packbits(odd.astype(np.uint8), axis=1, bitorder="little")
    return buckets.view(np.int64), packed.view("<i8")


def estimate(ones: np.ndarray) -> np.ndarray:
    """Similarity by the number of ones in the XOR of two sketches."""
    share = np.maximum(1 - 2 * np.asarray(ones) / BITS, 1e-9)
    return 1 + BITS / (4 * SAMPLES) * np.log(share)


def most_ones(percent: int) -> int:
    """The most ones that a pair of that similarity may have, DEVIATIONS from what it should."""
    similarity = percent / 100
    differing = 2 * SAMPLES * (1 - similarity)
    # of the samples, and of sample positions that fall together
    spread = math.sqrt(
        SAMPLES * similarity * (1 - similarity) + differing**2 / (4 * BITS)
    ) / SAMPLES
    least = similarity - DEVIATIONS * spread
    return math.floor(BITS / 2 * (1 - math.exp(4 * SAMPLES / BITS * (least - 1))))


def sketched(docs: DataFrame, shingle_words: int, id_column: str, text_column: str) -> DataFrame:
    """(row, doc_id, text_hash, n_shingles, set_key, buckets, sketch) of every document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for run in portions(texts):
                part = batch.slice(run.start, run.stop - run.start)
                sets = shingle_sets(texts[run], shingle_words)
                full = [i for i, s in enumerate(sets) if len(s)]
                minima = np.array([samples(sets[i]) for i in full], np.uint32)
                buckets, sketches = buckets_and_sketches(minima.reshape(-1, SAMPLES))
                sizes = np.array([len(s) for s in sets], np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes > 0)])
                columns = [
                    *(part.column(name) for name in ("row", "doc_id", "text_hash")),
                    pa.array(sizes),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    *(
                        pa.ListArray.from_arrays(
                            pa.array(bounds * found.shape[1], pa.int32()), pa.array(found.ravel())
                        )
                        for found in (buckets, sketches)
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", "doc_id", "text_hash", "n_shingles", "set_key", "buckets", "sketch"]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        text_hash(text_column).alias("text_hash"),
        whole_text(text_column).alias("text"),
    )
    return rows.mapInArrow(
        sketch,
        f"row long, doc_id {kind}, text_hash long, n_shingles long, set_key binary, "
        "buckets array<long>, sketch array<long>",
    )


def _full_sets(docs, nodes, shingle_words, id_column, text_column) -> DataFrame:
    """(node, shingles) of the nodes, from the text of the document that stands for each."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for run in portions(texts):
                sets = shingle_sets(texts[run], shingle_words)
                ends = np.cumsum([0] + [len(s) for s in sets])
                values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                part = batch.slice(run.start, run.stop - run.start)
                columns = [part.column("node"), part.column("n_shingles"), lists]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n_shingles", "shingles"])

    texts = docs.select(
        F.col(id_column).alias("of_id"),
        text_hash(text_column).alias("of_hash"),
        whole_text(text_column).alias("text"),
    )
    same = texts.of_id.eqNullSafe(nodes.doc_id) & (texts.of_hash == nodes.text_hash)
    found = texts.join(nodes.select("node", "doc_id", "text_hash", "n_shingles"), same)
    # not a column expression, which the filter below would take along to before the join
    found = found.select("node", "n_shingles", "text").mapInArrow(
        shingles, "node long, n_shingles long, shingles array<long>"
    )
    # rows with equal id and hash hold the same text
    return found.filter(F.size("shingles") == F.col("n_shingles")).dropDuplicates(["node"])


def _linked(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * inter >= percent * (a + b - inter)


def _star_links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked: by size, by sketch, then by full set."""

    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name),
            F.col("sketch").alias(f"sketch_{name}"),
            F.col("n_shingles").alias(f"n_{name}"),
        )

    ones = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    close = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .filter(ones <= most_ones(percent))
        .select("a", "b", "n_a", "n_b")
    )
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    inter = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    confirmed = close.join(first, "a").join(second, "b")
    return confirmed.filter(_linked(inter, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


class _Forest:
    """Which of some numbered things are joined."""

    def __init__(self, size: int):
        self.above = list(range(size))

    def root(self, n: int) -> int:
        while self.above[n] != n:
            self.above[n] = n = self.above[self.above[n]]
        return n

    def roots(self) -> np.ndarray:
        return np.array([self.root(n) for n in range(len(self.above))])

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.above[max(a, b)] = min(a, b)
        return a != b


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _sketch_words(table: pa.Table) -> np.ndarray:
    words = table.column("sketch").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return words.view(np.uint64).reshape(-1, BITS // 64)


def _close_sketches(mine, others, sizes, other_sizes, percent: int) -> np.ndarray:
    """Rows of ``mine`` against rows of ``others``: may the two be linked?"""
    ones = np.zeros((len(mine), len(others)), np.int64)
    for word in range(mine.shape[1]):
        ones += np.bitwise_count(mine[:, word, None] ^ others[None, :, word])
    low = np.minimum(sizes[:, None], other_sizes[None, :])
    high = np.maximum(sizes[:, None], other_sizes[None, :])
    return (ones <= most_ones(percent)) & (100 * low >= percent * high)


def _blocks(total: Column, size: int) -> Column:
    return F.ceil(total / F.lit(size)).cast("int")


def _own_block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")


def _open_groups(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between components whose members come close in a bucket.  ``members`` has (bucket,
    size, node, component) of the buckets whose members are apart."""
    dealt = members.withColumn("blocks", _blocks(F.col("size"), BLOCK))
    dealt = dealt.withColumn("own", _own_block("blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "bucket",
        "node",
        "component",
        "own",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    ).join(nodes.select("node", "sketch", "n_shingles"), "node")

    def search(cell: pa.Table) -> pa.Table:
        own, sizes = _numbers(cell.column("own")), _numbers(cell.column("n_shingles"))
        labels, number = np.unique(_numbers(cell.column("component")), return_inverse=True)
        words = _sketch_words(cell)
        low, high = int(own.min()), int(own.max())
        mine = np.flatnonzero(own == low)
        others = np.flatnonzero(own == high)
        # both blocks of a cell off the diagonal may come, or only one
        crossed = cell.column("i")[0].as_py() != cell.column("j")[0].as_py()
        forest, found = _Forest(len(labels)), []
        step = max(1, COMPARED_AT_ONCE // len(others))
        for start in range(0, len(mine) if low != high or not crossed else 0, step):
            some = mine[start : start + step]
            close = _close_sketches(words[some], words[others], sizes[some], sizes[others], percent)
            joined = forest.roots()[number]
            close &= joined[some][:, None] != joined[others][None, :]
            at, to = np.nonzero(close)
            edges = np.unique(np.stack([joined[some[at]], joined[others[to]]], axis=1), axis=0)
            found += [(a, b) for a, b in edges.tolist() if forest.join(a, b)]
        ends = labels[np.array(found, np.int64).reshape(-1, 2)]
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(search, "a long, b long")


def _exact_links(members: DataFrame, percent: int) -> DataFrame:
    """Links that join components within groups; ``members`` has (group, component, node, sketch,
    n_shingles, shingles) for all nodes of the groups."""
    sizes = members.groupBy("group", "component").agg(
        F.count("*").alias("nodes"), F.sum(8 * F.col("n_shingles") + BITS // 8).alias("bytes")
    )
    groups = sizes.groupBy("group").agg(
        F.max(F.struct("nodes", "component")).getField("component").alias("largest"),
        F.max(F.struct("nodes", "component", "bytes")).getField("bytes").alias("largest_bytes"),
        F.sum("bytes").alias("bytes"),
    )
    groups = groups.select(
        "group",
        "largest",
        _blocks(F.col("bytes"), BLOCK_BYTES).alias("point_blocks"),
        _blocks(F.col("bytes") - F.col("largest_bytes"), BLOCK_BYTES).alias("query_blocks"),
    )
    known = members.join(groups, "group")
    columns = ["group", "component", "node", "sketch", "n_shingles", "shingles"]
    points = known.select(
        *columns,
        F.lit(False).alias("query"),
        _own_block("point_blocks").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("j"),
    )
    queries = known.filter(F.col("component") != F.col("largest")).select(
        *columns,
        F.lit(True).alias("query"),
        F.explode(F.sequence(F.lit(0), F.col("point_blocks") - 1)).alias("i"),
        _own_block("query_blocks").alias("j"),
    )

    def search(cell: pa.Table) -> pa.Table:
        nodes, query = _numbers(cell.column("node")), cell.column("query").to_numpy()
        labels, number = np.unique(_numbers(cell.column("component")), return_inverse=True)
        sizes, words = _numbers(cell.column("n_shingles")), _sketch_words(cell)
        values = cell.column("shingles").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        _, ids = np.unique(values, return_inverse=True)
        ends = np.cumsum(sizes)
        mark = np.zeros(len(values) + 1, bool)
        points, asked = np.flatnonzero(~query), np.flatnonzero(query)
        forest, found = _Forest(len(labels)), []
        step = max(1, COMPARED_AT_ONCE // max(len(points), 1))
        for start in range(0, len(asked), step):
            some = asked[start : start + step]
            close = _close_sketches(words[some], words[points], sizes[some], sizes[points], percent)
            for at, row in zip(some.tolist(), close, strict=True):
                own = ids[ends[at] - sizes[at] : ends[at]]
                mark[own] = True
                for to in points[row].tolist():
                    if forest.root(number[at]) != forest.root(number[to]):
                        inter = int(mark[ids[ends[to] - sizes[to] : ends[to]]].sum())
                        if 100 * inter >= percent * (int(sizes[at]) + int(sizes[to]) - inter):
                            forest.join(number[at], number[to])
                            found.append((nodes[at], nodes[to]))
                mark[own] = False
        links = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    # the join has dealt by group, which would keep all blocks of a group in one task
    cells = points.unionAll(queries).repartition("group", "i", "j")
    return cells.groupBy("group", "i", "j").applyInArrow(search, "a long, b long")


def node_roots(
    docs: DataFrame, nodes: DataFrame, percent: int, shingle_words: int, id_column: str, text_column: str
) -> DataFrame:
    """(node, root) of all nodes that are linked with others; ``nodes`` has a row for each different
    set that is not empty."""
    held = nodes.select("node", F.explode("buckets").alias("bucket"))
    crowds = held.groupBy("bucket").agg(
        F.count("*").alias("size"),
        F.min("node").alias("pivot"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    # buckets of the same members are one
    crowds = crowds.filter("size > 1").groupBy("size", "pivot", "one", "two")
    crowds = crowds.agg(F.min("bucket").alias("bucket")).select("bucket", "size", "pivot")
    shared = materialise(held.join(crowds, "bucket"), "shared-buckets")
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi")
    sets = materialise(
        _full_sets(docs, wanted, shingle_words, id_column, text_column), "shingle-sets"
    )
    stars = shared.filter(F.col("node") != F.col("pivot"))
    stars = stars.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    first = materialise(star_components(_star_links(stars, nodes, sets, percent)), "roots")

    members = shared.filter("size > 2").join(first, "node", "left")
    members = members.select(
        "bucket", "size", "node", F.coalesce("root", "node").alias("component")
    )
    apart = members.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    apart = apart.filter("low < high").select("bucket")
    near = _open_groups(members.join(apart, "bucket", "left_semi"), nodes, percent)
    groups = star_components(near).select(
        F.col("node").alias("component"), F.col("root").alias("group")
    )
    grouped = (
        sets.select("node", "shingles")
        .join(first, "node", "left")
        .withColumn("component", F.coalesce("root", "node"))
        .join(groups, "component")
        .join(nodes.select("node", "sketch", "n_shingles"), "node")
        .select("group", "component", "node", "sketch", "n_shingles", "shingles")
    )
    second = _exact_links(materialise(grouped, "open-groups"), percent)
    kept = first.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return star_components(kept.unionAll(second))


def near_duplicates(
    docs: DataFrame,
    percent: int = PERCENT,
    shingle_words: int = SHINGLE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; component_id is the smallest id
    among the documents that links of at least ``percent`` similarity reach."""
    rows = materialise(sketched(docs, shingle_words, id_column, text_column), "odd-sketches")
    nodes = rows.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("row").alias("node"),
        F.count("*").alias("copies"),
        F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "text_hash")).alias("first"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("buckets").alias("buckets"),
        F.first("sketch").alias("sketch"),
    )
    nodes = materialise(nodes.select("*", "first.doc_id", "first.text_hash").drop("first"), "sets")
    roots = node_roots(docs, nodes, percent, shingle_words, id_column, text_column)
    labels = nodes.join(roots, "node", "left").select(
        "set_key", "copies", "least", F.coalesce("root", "node").alias("root")
    )
    lowest = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = materialise(labels.join(lowest, "root").drop("root", "least"), "set-labels")
    total = rows.count()
    heavy = F.col("copies") * HEAVY > total  # fewer than HEAVY sets
    common = F.broadcast(labels.filter(heavy).select("set_key", "component_id"))
    light = labels.filter(~heavy).select("set_key", "component_id")
    plain = rows.select("doc_id", "n_shingles", "set_key")
    full = plain.filter("n_shingles > 0")
    found = full.join(common, "set_key").unionAll(
        full.join(common.select("set_key"), "set_key", "left_anti").join(light, "set_key")
    )
    empty = plain.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return found.unionByName(empty).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op13_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
