"""Packing documents into windows in their own order, by dynamic programming over cut points.

The documents of a range of ids form one stream of tokens.  A window is a stretch of at most WIDTH
tokens between two cuts; it costs its padding, and the cut at its end costs nothing between
documents, a little between sentences and more inside a sentence.  With g(j) the least cost up to
cut j plus the position of j, g(j) = WIDTH + penalty(j) + min g(i) over the cuts i that lie at most
WIDTH tokens back.  That minimum slides, so a queue of candidates with rising g finds it in
constant time per cut.

A task reads its range in order, encodes GROUP_BYTES of text at a time and holds BLOCK_TOKENS; when
a block is full all but its last window are settled and the rest opens the next block.  Padding is lost to the end
of a range once per range.

Defined results: a null text counts as empty, and an empty text is its closing token alone; repeated
rows are packed once each; rows without an id come first; a document longer than a window spans
several; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import read_table, text_hash, whole_text
from tillroll.llm.tokens import word_encoder

VOCABULARY = "word_bpe_49k.json"
WIDTH = 2048
CLOSING_ID = 1
BLOCK_TOKENS = 1 << 19
SENTENCE_PENALTY = 2
HARD_PENALTY = 12
GROUP_BYTES = 8_000_000
ROW_BYTES = 64  # what a row counts for besides its text
HARD_STEP = 16  # cuts inside a sentence lie this far apart

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def window_cuts(positions: Sequence[int], penalties: Sequence[int], width: int) -> list[int]:
    """Indices of the cheapest cuts, first and last included.  Neighbouring positions must be at
    most ``width`` apart."""
    cost = [0] * len(positions)
    came_from = [0] * len(positions)
    rising = deque([0])
    for j in range(1, len(positions)):
        while positions[rising[0]] < positions[j] - width:
            rising.popleft()
        came_from[j] = rising[0]
        cost[j] = cost[rising[0]] + width + penalties[j]
        while rising and cost[rising[-1]] >= cost[j]:
            rising.pop()
        rising.append(j)
    cuts = [len(positions) - 1]
    while cuts[-1]:
        cuts.append(came_from[cuts[-1]])
    return cuts[::-1]


def cut_points(ids: np.ndarray, ends: np.ndarray, sentence_ends: np.ndarray) -> tuple:
    """(positions, penalties) of the possible cuts of a block; ``ends`` are its documents' ends."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[HARD_STEP::HARD_STEP] = HARD_PENALTY
    known = ids < len(sentence_ends)
    after = np.flatnonzero(sentence_ends[np.where(known, ids, 0)] & known) + 1
    # steps inside sentences matter only where no sentence ends nearby
    near = np.unique(np.concatenate([after // HARD_STEP, ends // HARD_STEP])) * HARD_STEP
    penalty[near[near < len(penalty)]] = -1
    penalty[after] = SENTENCE_PENALTY
    penalty[ends] = 0
    penalty[0] = penalty[len(ids)] = 0
    positions = np.flatnonzero(penalty >= 0)
    return positions, penalty[positions]


class Packer:
    """Takes documents in order and returns settled pieces."""

    def __init__(self, sentence_ends: np.ndarray, width: int, first_sequence: int):
        self.sentence_ends, self.width = sentence_ends, width
        self.sequence = first_sequence
        self.open: list[tuple] = []  # (doc_id, ids, start, tokens of the document)
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.open.append((doc_id, ids, 0, len(ids)))
        self.tokens += len(ids)

    def settle(self, everything: bool = False) -> Iterator[tuple]:
        """Pieces of the cheapest windows, without the last one unless nothing will follow."""
        if not self.open:
            return
        ids = np.concatenate([ids for _, ids, _, _ in self.open])
        ends = np.cumsum([len(ids) for _, ids, _, _ in self.open])
        positions, penalties = cut_points(ids, ends, self.sentence_ends)
        cuts = positions[window_cuts(positions.tolist(), penalties.tolist(), self.width)].tolist()
        settled = len(cuts) - 1 if everything else max(0, len(cuts) - 2)
        at, number = 0, 0  # position in the block, document it lies in
        for window_end in cuts[1 : settled + 1]:
            offset = 0
            while at < window_end:
                doc_id, own, start, tokens = self.open[number]
                first = int(ends[number]) - len(own)
                stop = min(window_end, int(ends[number]))
                piece = own[at - first : stop - first]
                checksum = zlib.crc32(np.ascontiguousarray(piece, "<u4"))
                yield (
                    doc_id, start + at - first, stop - at, checksum, tokens, self.sequence, offset
                )
                offset += stop - at
                at = stop
                number += at == ends[number]
            self.sequence += 1
        rest = []
        for (doc_id, own, start, tokens), end in zip(
            self.open[number:], ends[number:].tolist(), strict=True
        ):
            skip = max(0, at - (end - len(own)))
            rest.append((doc_id, own[skip:].copy(), start + skip, tokens))
        self.open, self.tokens = rest, len(ids) - at


def text_groups(
    batches: Iterator[pa.RecordBatch], group_bytes: int = GROUP_BYTES
) -> Iterator[pa.Table]:
    """The rows in order, with about ``group_bytes`` of text together or a single longer one."""
    held, size, slot = [], 0, 0
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        ends = size + np.cumsum(lengths.astype(np.int64) + ROW_BYTES)
        slots = ends // group_bytes
        done = 0
        for at in np.flatnonzero(np.diff(slots, prepend=slot)).tolist():
            held.append(batch.slice(done, at - done))
            yield pa.Table.from_batches(held)
            held, done = [], at
        held.append(batch.slice(done))
        if batch.num_rows:
            size, slot = int(ends[-1]), int(slots[-1])
    if held:
        yield pa.Table.from_batches(held)


def packed(
    docs: DataFrame,
    vocabulary: str | None = None,
    width: int = WIDTH,
    closing_id: int = CLOSING_ID,
    block_tokens: int = BLOCK_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row per piece; windows of a range of ids count up from the range's number times 2**32.

    ``vocabulary`` is the path of a tokenizer file that all executors have; by default that of the
    installed public vocabularies.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(str(vocabulary))
        packer = Packer(encoder.sentence_ends(), width, TaskContext.get().partitionId() << 32)
        closing = np.array([closing_id], "<u4")
        columns = [c.split()[0] for c in PIECES.split(", ")]

        def batch_of(pieces: Iterator[tuple]) -> pa.RecordBatch:
            rows = list(pieces)
            values = zip(*rows, strict=True) if rows else [[] for _ in columns]
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], columns)

        for group in text_groups(batches):
            ids, ends = encoder.batch(group.column("text").combine_chunks())
            bounds = zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            for doc_id, (start, end) in zip(group.column("doc_id").to_pylist(), bounds, strict=True):
                packer.add(doc_id, np.concatenate([ids[start:end], closing]))
                if packer.tokens >= block_tokens:
                    yield batch_of(packer.settle())
        yield batch_of(packer.settle(everything=True))

    # rows of one id, equal ones as well, may lie in several ranges
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_hash(text_column).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
        whole_text(text_column).alias("text"),
    )
    order = ["doc_id", "hash", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "text").mapInArrow(pack, PIECES)


def op2_ordered_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 2048 tokens."""
    return packed(read_table(spark, folder, "documents"))
