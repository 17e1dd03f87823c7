"""Alignment of two tokenizers over the same texts, by divide and conquer at shared cuts.

Tokenizer A is a byte-level encoding read by ``tokenizers``, B a ``sentencepiece`` model with byte
fallback.  Both encode a space and the text (B adds the space itself), so the bytes of their tokens
spell the same string and every token ends at a byte offset.  An interval of tokens between two
offsets where both have an end is halved: from its middle token of A outwards, the first end that a
bisection also finds among the ends of B cuts it in two, which are treated alike.  An interval
without such a cut is a leaf: a group of tokens of A and of B that cover the same bytes and cannot
be taken apart.  All intervals of a batch of documents are halved side by side, one level at a time.

All tokens of A in a group are linked with all of B in it.  How many documents hold a pair of ids
linked is counted over the whole corpus; ``documents_with_counts`` brings the counts back to the
documents.  Each document stores its different pairs once, with their number.  The few pairs that
make up most links are found by their share of all of them, which bounds their number; they are
broadcast, and only links of rarer pairs are shuffled, so that no pair is hot.

Defined results: a null or empty text, or one that either tokenizer does not spell back byte for
byte, has no tokens: zeros, and '' in place of the digest.  Rows are documents: repeated rows get
equal values and count as often as they come.  An empty table gives no rows.  Further columns are
left out.  A task holds a few hundred documents, or one long one, with their links.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import portions, read_table
from tillroll.session import materialise

# Pairs with more than this part of all (document, pair) rows are broadcast: at most so many.
FREQUENT = 100_000
CACHED_WORDS = 500_000
CACHED_CHARACTERS = 20_000_000
LINKS_AT_ONCE = 4_000_000
BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 0x20]
TOUCHING = re.compile(r"\s \s")


# A word of plain letters with marks behind it; the byte-level encoding cuts between the two.
SIMPLE_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _blanks_touch(text: str) -> bool:
    """Whether words between single spaces cannot be encoded by themselves: both tokenizers treat
    runs of blanks as a whole, and the second spells a space as U+2581."""
    if text[0] == " " or text[-1] == " " or "  " in text or "▁" in text:
        return True
    return any(f"{blank} " in text for blank in BLANKS) and bool(TOUCHING.search(text))


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and number the rest from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level encoding; ``spelled`` has the bytes of every id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        letters = _byte_of_letter()
        vocabulary = self.tokenizer.get_vocab()
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.spelled[number] = bytes(letters[c] for c in token)
        self.letter = {byte: letter for letter, byte in letters.items()}
        self.space = self.letter[0x20]
        self.marks = functools.lru_cache(10_000)(self._part)

    def _part(self, written: str) -> list[int]:
        """Ids of what the encoding never cuts before it merges, written in its letters."""
        return [token.id for token in self.model.tokenize(written)]

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text with a space before it."""
        out = []
        for text in texts:
            simple = SIMPLE_WORD.fullmatch(text)
            if simple is None:
                out.append(self.tokenizer.encode(" " + text, add_special_tokens=False).ids)
            else:
                word, marks = simple.groups()
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(self.letter)
                ids = self._part(self.space + word)
                out.append(ids + self.marks(marks) if marks else ids)
        return out


class Pieces:
    """A sentencepiece model; ``spelled`` has the bytes of every id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [
            bytes([int(piece[1:-1], 16)])
            if self.model.is_byte(i)
            else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; the model puts a space before it, but for an empty one."""
        return self.model.encode(texts, num_threads=1)


class Encoders:
    """Both encodings of many texts at once.

    Neither looks across a single space between two words, so a text is cut into words there,
    unless blanks touch in it, and each different word is encoded once and kept for a while.
    """

    def __init__(self, first: ByteLevel, second: Pieces):
        self.both = (first, second)
        self.lengths = [np.array([len(t) for t in e.spelled], np.int64) for e in self.both]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.characters = 0
        self.fits = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int64)] * 2
        self.ends = [np.zeros(1, np.int64)] * 2

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > CACHED_WORDS or self.characters > CACHED_CHARACTERS:
            self._forget()
        fresh = [word for word in dict.fromkeys(words) if word not in self.number]
        if fresh:
            self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
            self.characters += sum(map(len, fresh))
            found = [encoder.ids(fresh) for encoder in self.both]
            spelled = (
                [b"".join(map(e.spelled.__getitem__, ids)) for ids in of]
                for e, of in zip(self.both, found, strict=True)
            )
            fits = [
                a == b == b" " + word.encode() for word, a, b in zip(fresh, *spelled, strict=True)
            ]
            self.fits = np.concatenate([self.fits, np.array(fits, bool)])
            for k, of in enumerate(found):
                sizes = np.fromiter(map(len, of), np.int64, len(of))
                flat = np.fromiter(itertools.chain.from_iterable(of), np.int64, int(sizes.sum()))
                self.ids[k] = np.concatenate([self.ids[k], flat])
                self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(sizes)])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each encoding the ids of all texts end to end, and where each text begins and ends;
        none for a text that is empty or not spelled back."""
        words, bounds = [], [0]
        for text in texts:
            if text:
                words += [text] if _blanks_touch(text) else text.split(" ")
            bounds.append(len(words))
        bounds = np.array(bounds)
        taken = self._numbers(words)
        misfits = np.concatenate([[0], np.cumsum(~self.fits[taken])])
        spelled = np.repeat(np.diff(misfits[bounds]) == 0, np.diff(bounds))
        out = []
        for ids, ends in zip(self.ids, self.ends, strict=True):
            starts = ends[taken]
            sizes = np.where(spelled, ends[taken + 1] - starts, 0)
            before = np.concatenate([[0], np.cumsum(sizes)])
            places = np.arange(before[-1]) + np.repeat(starts - before[:-1], sizes)
            out.append((ids[places], before[bounds]))
        return out


@functools.cache
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


@functools.cache
def encoders(a_path: str, b_path: str) -> Encoders:
    """One for each Python worker."""
    return Encoders(byte_level(a_path), pieces(b_path))


@functools.cache
def _spellings(a_size: int, b_size: int) -> list[bytes]:
    """Decimal ids behind a comma and behind a semicolon (A), behind a comma and behind a bar (B)."""
    marks = ((b",", a_size), (b";", a_size), (b",", b_size), (b"|", b_size))
    return [mark + str(i).encode() for mark, size in marks for i in range(size)]


def _widening(a_ends, b_ends, low: int, high: int, middle: int) -> int:
    """The index nearest to ``middle`` in [low, high) whose end of A is one of B, or -1."""
    width = 16
    left, right = middle, middle
    while left > low or right < high:
        new_left, new_right = max(low, left - width), min(high, right + width)
        tried = np.concatenate([np.arange(new_left, left), np.arange(right, new_right)])
        ends = a_ends[tried]
        hits = tried[b_ends[np.searchsorted(b_ends, ends)] == ends]
        if len(hits):
            return int(hits[np.argmin(np.abs(hits - middle))])
        left, right, width = new_left, new_right, 2 * width
    return -1


def shared_cuts(
    a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as numbers of tokens of A and of B before, in order.

    ``a_ends`` and ``b_ends`` rise over all documents; document k has the tokens of A from
    ``a_bounds[k]`` to ``a_bounds[k + 1]``, and of B likewise, none or some of both.
    """
    some = np.diff(a_bounds) > 0
    a_low, a_high = a_bounds[:-1][some], a_bounds[1:][some]
    b_low, b_high = b_bounds[:-1][some], b_bounds[1:][some]
    a_cuts, b_cuts = [a_high], [b_high]
    while len(a_low):
        wide = (a_high - a_low > 1) & (b_high - b_low > 1)  # others have no end inside
        a_low, a_high, b_low, b_high = a_low[wide], a_high[wide], b_low[wide], b_high[wide]
        middle = (a_low + a_high) // 2 - 1
        at = np.full(len(a_low), -1)
        left = np.arange(len(a_low))
        for step in (0, 1, -1, 2, -2, 3, -3):
            tried = middle[left] + step
            inside = (tried >= a_low[left]) & (tried < a_high[left] - 1)
            ends = a_ends[np.where(inside, tried, 0)]
            hit = inside & (b_ends[np.searchsorted(b_ends, ends)] == ends)
            at[left[hit]] = tried[hit]
            left = left[~hit]
            if not len(left):
                break
        long = left[a_high[left] - a_low[left] > 7]
        for k in long:
            at[k] = _widening(a_ends, b_ends, a_low[k], a_high[k] - 1, middle[k])
        found = at >= 0
        a_cut = at[found] + 1
        b_cut = np.searchsorted(b_ends, a_ends[at[found]]) + 1
        a_cuts.append(a_cut)
        b_cuts.append(b_cut)
        # halves stay in order, so that bisections of neighbours touch the same ends
        a_low, a_high, b_low, b_high = (
            np.stack(halves, axis=1).ravel()
            for halves in (
                (a_low[found], a_cut),
                (a_cut, a_high[found]),
                (b_low[found], b_cut),
                (b_cut, b_high[found]),
            )
        )
    return np.sort(np.concatenate(a_cuts)), np.sort(np.concatenate(b_cuts))


@dataclass
class Aligned:
    """Some documents: ids of both tokenizers end to end, and where documents and groups end."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None], both: Encoders) -> Aligned:
        (a, a_bounds), (b, b_bounds) = both.encode(texts)
        a_ends, b_ends = (np.cumsum(l[ids]) for l, ids in zip(both.lengths, (a, b), strict=True))
        return cls(a, b, a_bounds, b_bounds, *shared_cuts(a_ends, b_ends, a_bounds, b_bounds))

    def group_bounds(self) -> np.ndarray:
        """Number of groups before each document, and of all."""
        return np.searchsorted(self.a_cuts, self.a_bounds, "right")

    def digests(self, a_size: int, b_size: int) -> list[str]:
        """SHA-256 of every document's groups, '' without tokens."""
        spellings = _spellings(a_size, b_size)
        a_starts = np.concatenate([[0], self.a_cuts[:-1]]).astype(np.int64)
        b_starts = np.concatenate([[0], self.b_cuts[:-1]]).astype(np.int64)
        a_code, b_code = self.a.copy(), self.b + 2 * a_size
        a_code[a_starts[: len(self.a_cuts)]] += a_size
        b_code[b_starts[: len(self.b_cuts)]] += b_size
        merged = np.empty(len(self.a) + len(self.b), np.int64)
        a_size_of, b_size_of = self.a_cuts - a_starts, self.b_cuts - b_starts
        merged[np.arange(len(self.a)) + np.repeat(b_starts, a_size_of)] = a_code
        merged[np.arange(len(self.b)) + np.repeat(self.a_cuts, b_size_of)] = b_code
        bounds = self.a_bounds + self.b_bounds
        out = []
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            spelled = b"".join(map(spellings.__getitem__, merged[start:end].tolist()))
            out.append(hashlib.sha256(spelled[1:]).hexdigest() if end > start else "")
        return out

    def link_numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """Links of each group, and of each document."""
        links = np.diff(self.a_cuts, prepend=0) * np.diff(self.b_cuts, prepend=0)
        total = np.concatenate([[0], np.cumsum(links)])
        return links, np.diff(total[self.group_bounds()])

    def pairs(self, b_size: int, a_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different linked pairs of each document as a_id * b_size + b_id, their number in it, and
        how many pairs lie before each document."""
        links, _ = self.link_numbers()
        before = np.concatenate([[0], np.cumsum(links)]).astype(np.int64)
        group_document = np.repeat(np.arange(len(self.a_bounds) - 1), np.diff(self.group_bounds()))
        a_starts = np.concatenate([[0], self.a_cuts[:-1]]).astype(np.int64)
        b_starts = np.concatenate([[0], self.b_cuts[:-1]]).astype(np.int64)
        b_size_of = self.b_cuts - b_starts
        codes, numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, int(before[-1]), LINKS_AT_ONCE):
            end = min(start + LINKS_AT_ONCE, int(before[-1]))
            first = np.searchsorted(before, start, "right") - 1
            last = np.searchsorted(before, end, "left")
            taken = np.minimum(before[first + 1 : last + 1], end) - np.maximum(before[first:last], start)
            group = np.repeat(np.arange(first, last), taken)
            place = np.arange(start, end) - before[group]
            a = self.a[a_starts[group] + place // b_size_of[group]]
            b = self.b[b_starts[group] + place % b_size_of[group]]
            code = (group_document[group] * a_size + a) * b_size + b
            more, times = np.unique(code, return_counts=True)
            if len(codes):
                both, where = np.unique(np.concatenate([codes, more]), return_inverse=True)
                added = np.zeros(len(both), np.int64)
                np.add.at(added, where, np.concatenate([numbers, times]))
                codes, numbers = both, added
            else:
                codes, numbers = more, times
        size = a_size * b_size
        bounds = np.searchsorted(codes, np.arange(len(self.a_bounds), dtype=np.int64) * size)
        return codes % size, numbers, bounds


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _texts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for run in portions(batch.column(text).to_pylist()):
        part = batch.slice(run.start, run.stop - run.start)
        yield part, part.column(text).to_pylist()


def alignments(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """The id of every document, its ids by both tokenizers, and where its groups end in them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(a_path, b_path)
        for batch in batches:
            for part, texts in _texts(batch, "text"):
                found = Aligned.of(texts, both)
                groups = found.group_bounds()
                owner = np.repeat(np.arange(len(texts)), np.diff(groups))
                columns = [
                    part.column("doc_id"),
                    _lists(found.a, found.a_bounds, pa.int32()),
                    _lists(found.b, found.b_bounds, pa.int32()),
                    _lists(found.a_cuts - found.a_bounds[owner], groups, pa.int32()),
                    _lists(found.b_cuts - found.b_bounds[owner], groups, pa.int32()),
                ]
                names = ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, " + ", ".join(
        f"{name} array<int>" for name in ("a_ids", "b_ids", "a_cuts", "b_cuts")
    )
    rows = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(aligned, schema)


@dataclass
class Links:
    """Documents with their different linked pairs, stored, and the size of B's vocabulary."""

    documents: DataFrame
    b_size: int

    @classmethod
    def of(cls, docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> Links:
        kind = docs.schema["doc_id"].dataType.simpleString()
        a_size, b_size = len(byte_level(a_path).spelled), len(pieces(b_path).spelled)

        def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both = encoders(a_path, b_path)
            for batch in batches:
                for part, texts in _texts(batch, "text"):
                    found = Aligned.of(texts, both)
                    codes, numbers, bounds = found.pairs(b_size, a_size)
                    counted = (
                        np.diff(found.a_bounds),
                        np.diff(found.b_bounds),
                        np.diff(found.group_bounds()),
                        found.link_numbers()[1],
                    )
                    columns = [
                        part.column("row"),
                        part.column("doc_id"),
                        *(pa.array(c, pa.int64()) for c in counted),
                        pa.array(found.digests(a_size, b_size), pa.string()),
                        _lists(codes, bounds, pa.int64()),
                        _lists(numbers, bounds, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

        names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        names += ["pairs", "numbers"]
        rows = docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.col(text).cast("string").alias("text"),
        )
        schema = (
            f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, pairs array<long>, numbers array<long>"
        )
        return cls(materialise(rows.mapInArrow(linked, schema), "alignments"), b_size)

    def counts(self) -> DataFrame:
        """(pair, a_id, b_id, count, best): in how many documents a pair is linked, and whether no
        pair of its A id is in more."""
        pair = self.documents.select(F.explode("pairs").alias("pair")).groupBy("pair")
        counted = materialise(pair.agg(F.count("*").alias("count")), "pair-counts").select(
            "pair",
            F.expr(f"pair div {self.b_size}").alias("a_id"),
            (F.col("pair") % self.b_size).alias("b_id"),
            "count",
        )
        # a row for each id of A's vocabulary at most
        best = counted.groupBy("a_id").agg(F.max("count").alias("most"))
        return counted.join(F.broadcast(best), "a_id").select(
            "pair", "a_id", "b_id", "count", (F.col("count") == F.col("most")).alias("best")
        )

    def documents_with_counts(self) -> DataFrame:
        """Every document with ``count_sum``, the counts of its links added up, and ``n_best``, its
        links whose pair is the best of its A id."""
        counts = self.counts()
        total = counts.agg(F.sum("count")).first()[0] or 0
        often = F.col("count") * F.lit(FREQUENT) > F.lit(total)
        scores = counts.select("pair", "count", "best", often.alias("often"))
        frequent = F.broadcast(scores.filter("often").drop("often"))
        links = self.documents.select(
            "row", F.explode(F.arrays_zip("pairs", "numbers")).alias("link")
        ).select("row", F.col("link.pairs").alias("pair"), F.col("link.numbers").alias("number"))

        def summed(scored: DataFrame) -> DataFrame:
            return scored.groupBy("row").agg(
                F.sum(F.col("number") * F.col("count")).alias("count_sum"),
                F.sum(F.when(F.col("best"), F.col("number")).otherwise(0)).alias("n_best"),
            )

        known = summed(links.join(frequent, "pair"))
        rare = links.join(frequent.select("pair"), "pair", "left_anti")
        rest = summed(rare.join(scores.filter("NOT often"), "pair"))
        sums = known.unionAll(rest).groupBy("row")
        sums = sums.agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
        return (
            self.documents.drop("pairs", "numbers")
            .join(sums, "row", "left")
            .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("count_sum", "n_best")})
            .drop("row")
        )


def op12_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document aligned, with its links by how common they are."""
    import public_tokenizers

    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return Links.of(read_table(spark, sf_dir, "documents"), *paths).documents_with_counts()
