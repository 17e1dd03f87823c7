"""Secrets in texts and in whatever the texts wrap: a worklist of decoded layers.

A text is the first layer.  A layer gives further ones: itself with percent escapes decoded, itself
with character escapes decoded, and what each run of base64 holds, as text or as compressed streams
of text.  What stands before base64 may look like a part of it ("/login/", "img_"), so a run is
decoded from each of its first four characters, and streams are looked for all along it.  A run goes
on over line breaks.  Each new layer is scanned and decoded in turn until nothing new appears; a layer that was
already seen for the same stretch of the document is not opened again, so a stream that unpacks to
itself ends there.  A find in a layer is mapped back to the stretch of the document that it was
decoded from: to the character for escapes; for base64 to the whole run if it is read from its first
character and on one line, else to the characters that hold the find or the stream with it.

Defined results: a null text counts as empty; a text without finds has an empty list and the digest
of the empty string; a find that maps to a span already listed is listed once; repeated rows get
equal results; a stream that unpacks to more than MAX_LAYER bytes is scanned in pieces and counted in
n_unopened, as a stream or a run of base64 inside it is only read as far as a piece holds it; one
that needs more than MAX_WINDOW bytes of memory is counted there too, and not scanned; an empty
table gives no rows.
"""

from __future__ import annotations

import binascii
import bz2
import contextlib
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import read_table, whole_text

KINDS = ("assign", "access", "hex")
MAX_LAYER = 1 << 26
MAX_WINDOW = 1 << 27  # of the decoders of xz and zstd
FEED = 1 << 10  # bytes given to a decoder at a time, so that what comes out stays small

ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, as nothing shorter than 24 counts

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
ESCAPED = re.compile(r"\\[uUx]\{?([0-9A-Fa-f]+)\}?|&#[xX]([0-9A-Fa-f]+);|&#([0-9]+);")
# runs of base64, going on over line breaks (also escaped ones, and with quoting in the margin)
BASE64 = re.compile(
    r"[A-Za-z0-9+/_-]+(?:[\x20\t]*+(?:\r?\n|\r|(?:\\r)?\\n)[\x20\t>]*+[A-Za-z0-9+/_-]+)*+={0,2}"
)
BREAK = re.compile(r"[\x20\t]*+(?:\r?\n|\r|(?:\\r)?\\n)[\x20\t>]*+")
MIN_RUN = 16
MAGIC = re.compile(
    rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd"
)
# ASCII in UTF-16 of either order, shorter than any find
WIDE = re.compile(rb"(?:[\x01-\x7f]\x00){8}|(?:\x00[\x01-\x7f]){8}")
# what a find, an escape or a run of base64 may be made of, also in UTF-16
UNFINISHED = bytes({*range(0x21, 0x7F)} - {*b"!$()*,<?@[]^`|~"}) + b"\x00 \t\r\n"

Span = tuple[int, int, int]  # start, place of the kind, end


def scan(text: str) -> list[Span]:
    """Finds of the fixed kinds in one layer."""
    spans = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


@dataclass
class Layer:
    """A text, and for each of its characters the stretch of the document it stems from: arrays,
    one stretch for all, or None if it is the document itself."""

    text: str
    starts: np.ndarray | int | None = None
    ends: np.ndarray | int | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """The layer with all matches decoded; None if nothing changes."""
        parts, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            plain = decode(m[0])
            if plain == m[0]:
                continue
            low, high = self.origin(m.start(), m.end())
            parts += [self.text[at : m.start()], plain]
            starts += [self.bounds(at, m.start(), 0), np.full(len(plain), low, np.int64)]
            ends += [self.bounds(at, m.start(), 1), np.full(len(plain), high, np.int64)]
            at = m.end()
        if not parts:
            return None
        parts.append(self.text[at:])
        if isinstance(self.starts, int):
            return Layer("".join(parts), self.starts, self.ends)
        starts.append(self.bounds(at, len(self.text), 0))
        ends.append(self.bounds(at, len(self.text), 1))
        return Layer("".join(parts), np.concatenate(starts), np.concatenate(ends))

    def bounds(self, start: int, end: int, upper: int) -> np.ndarray:
        if self.starts is None:
            return np.arange(start + upper, end + upper)
        own = (self.starts, self.ends)[upper]
        return np.full(end - start, own, np.int64) if isinstance(own, int) else own[start:end]


def percent_decoded(escapes: str) -> str:
    return bytes.fromhex(escapes.replace("%", "")).decode("utf-8", "replace")


def unescaped(escapes: str) -> str:
    """Characters of a run of escapes; pairs of surrogates are joined."""
    codes = [
        int(m[1] or m[2], 16) if m[1] or m[2] else int(m[3]) for m in ESCAPED.finditer(escapes)
    ]
    if any(code > 0x10FFFF for code in codes):
        return escapes
    joined = "".join(map(chr, codes)).encode("utf-16-le", "surrogatepass")
    return joined.decode("utf-16-le", "replace")


class TooLarge(Exception):
    pass


def _decoder(head: bytes):
    """A decoder of the compressed stream that starts like this; None if none does."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=MAX_WINDOW)
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=MAX_WINDOW).decompressobj()
    return None


def pieces(data: bytes) -> Iterator[bytes]:
    """What the compressed streams at the head of ``data`` hold, one stream after the other, as
    far as they are undamaged; TooLarge if a decoder needs too much memory."""
    view, at = memoryview(data), 0
    while (stream := _decoder(bytes(view[at : at + 6]))) is not None:
        while not stream.eof and at < len(view):
            given = bytes(view[at : at + FEED])
            try:
                out = stream.decompress(given)
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError) as error:
                if isinstance(error, lzma.LZMAError) and "emory" in str(error):
                    raise TooLarge from error
                return
            except zstandard.ZstdError as error:
                if "memory" in str(error):
                    raise TooLarge from error
                return
            at += len(given) - (len(stream.unused_data) if stream.eof else 0)
            if out:
                yield out
        # xz streams may be padded with NULs
        while isinstance(stream, lzma.LZMADecompressor) and bytes(view[at : at + 4]) == bytes(4):
            at += 4


def inflated(data: bytes) -> bytes | None:
    """What compressed streams hold; None if there is none."""
    parts, size = [], 0
    for piece in pieces(data):
        parts.append(piece)
        size += len(piece)
        if size > MAX_LAYER:
            raise TooLarge
    return b"".join(parts) or None


def windows(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Parts of a large stream, put together to about MAX_LAYER bytes; each window starts with
    what may be unfinished at the end of the one before, blanks squeezed."""
    held, size = [], 0
    with contextlib.suppress(TooLarge):
        for part in parts:
            held.append(part)
            size += len(part)
            if size >= MAX_LAYER:
                window = b"".join(held)
                yield window
                begin = max(len(window.rstrip(UNFINISHED)), len(window) - MAX_LAYER // 2)
                held = [re.sub(rb"\x20{2,}", b" ", window[begin:])]
                size = len(held[0])
    yield b"".join(held)


def contents(data: bytes, unopened: list) -> Iterator[tuple[int, str]]:
    """All texts in ``data`` other than its own bytes, and from which byte on they are held: as
    UTF-16, and in compressed streams anywhere in it, to any depth."""

    def opened_streams(data: bytes) -> Iterator[tuple[int, bytes]]:
        for m in MAGIC.finditer(data):
            stream = memoryview(data)[m.start() :]
            try:
                inner = inflated(stream)
            except TooLarge:
                unopened.append(m.start())
                yield from ((m.start(), window) for window in windows(pieces(stream)))
                continue
            if inner:
                yield m.start(), inner

    if WIDE.search(data):
        yield from ((0, text) for text in wide_texts(data))
    todo, seen, begin = [opened_streams(data)], set(), 0
    while todo:
        at, inner = next(todo[-1], (0, None))
        if inner is None:
            todo.pop()
            continue
        begin = at if len(todo) == 1 else begin
        digest = hashlib.sha1(inner).digest()
        if digest in seen:
            continue
        seen.add(digest)
        yield begin, as_text(inner)
        if WIDE.search(inner):
            yield from ((begin, text) for text in wide_texts(inner))
        todo.append(opened_streams(inner))


def wide_texts(data: bytes) -> Iterator[str]:
    """``data`` read as UTF-16 of both orders, from either byte."""
    for order in ("utf-16-le", "utf-16-be"):
        for first in (0, 1):
            yield data[first:].decode(order, "replace")


def decoded(run: str) -> bytes:
    """The bytes in base64 from its first character on; a last character too many is left out."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def opened(data: bytes) -> bytes | None:
    """What is left after any number of compressed streams; None if one unpacks to itself."""
    seen = set()
    while (inner := inflated(data)) is not None:
        digest = hashlib.sha1(inner).digest()
        if digest in seen:
            return None
        seen.add(digest)
        data = inner
    return data


def as_text(data: bytes) -> str:
    """A character for each byte: all that is looked for is ASCII, so other bytes may be anything."""
    return data.decode("latin-1")


def unwrapped(run: str) -> str | None:
    """The text in a run of base64, through any number of compressed streams."""
    data = opened(decoded(run))
    return as_text(data) if data else None


def wrapped_layers(layer: Layer, m: re.Match, unopened: list) -> Iterator[Layer]:
    """Layers that a run of base64 gives, read from each of its first four characters."""
    breaks = list(BREAK.finditer(m[0]))
    run = BREAK.sub("", m[0]) if breaks else m[0]
    if len(run.rstrip("=")) < MIN_RUN:
        return
    inside = layer.starts is not None and isinstance(layer.starts, int)
    if not inside:
        places = np.arange(len(m[0]))
        if breaks:
            places = np.delete(places, np.concatenate([np.arange(*b.span()) for b in breaks]))
        starts = layer.bounds(m.start(), m.end(), 0)[places]
        ends = layer.bounds(m.start(), m.end(), 1)[places]
    for first in range(4):
        data = decoded(run[first:])
        if inside or (first == 0 and not breaks):
            stretch = layer.origin(m.start(), m.end())
            yield Layer(as_text(data), *stretch)
        else:
            at = np.arange(len(data))
            yield Layer(as_text(data), starts[first + at * 4 // 3], ends[first + (at * 4 + 3) // 3])
            stretch = None
        for begin, text in contents(data, unopened):
            held = slice(first + begin * 4 // 3, None)
            yield Layer(text, *(stretch or (int(starts[held].min()), int(ends[held].max()))))


def inner_layers(layer: Layer, unopened: list) -> Iterator[Layer]:
    """What one step of decoding makes of a layer, one at a time, as they may be large."""
    if "%" in layer.text and (found := layer.replaced(PERCENT, percent_decoded)):
        yield found
    if ("\\" in layer.text or "&#" in layer.text) and (found := layer.replaced(ESCAPE, unescaped)):
        yield found
    for m in BASE64.finditer(layer.text):
        if m.end() - m.start() >= MIN_RUN:
            yield from wrapped_layers(layer, m, unopened)


def find_secrets(text: str) -> tuple[list[Span], list[Span], int]:
    """(finds in the text itself, all finds, streams too large to open)."""
    base = sorted(scan(text))
    spans, unopened = set(base), []
    worklist, seen = [inner_layers(Layer(text), unopened)], set()
    while worklist:
        found = next(worklist[-1], None)
        if found is None:
            worklist.pop()
            continue
        stretch = found.origin(0, len(found.text)) if found.text else (0, 0)
        key = (hashlib.sha1(found.text.encode("utf-8", "surrogatepass")).digest(), stretch)
        if key in seen:
            continue
        seen.add(key)
        for start, kind, end in scan(found.text):
            low, high = found.origin(start, end)
            spans.add((low, kind, high))
        worklist.append(inner_layers(found, unopened))
    return base, sorted(spans), len(unopened)


def span_list(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SECRETS = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_added long, n_unopened long"
)


def secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per document: counts and digest of the finds in the text itself, all spans, how many
    the layers added, and how many streams were too large."""
    columns = [c.split()[0] for c in SECRETS.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                base, spans, unopened = find_secrets(text)
                counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
                digest = hashlib.sha256(span_list(base).encode()).hexdigest()
                added = len(set(spans)) - len(set(base))
                out.append([doc_id, *counts, digest, span_list(spans), added, unopened])
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text")
    )
    return narrow.mapInPandas(rows, SECRETS)


def op8_secret_worklist(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, in its text and in what the text wraps."""
    return secrets(read_table(spark, folder, "documents"))
