"""Legacy web archives (ARC, versions 1 and 2) converted to WARC.

An ARC file opens with a block that names its version and the fields of its header lines; each
record is such a line and then as many bytes as its last field declares.  The converter reads them
in place, whatever the bytes contain, and writes WARC records with what ARC lacks: an identifier
made from archive name and offset, an ISO time from the 14 digits, a type (response for HTTP, else
resource, warcinfo for the opening block), and SHA-1 digests of block and payload.  Of responses
with equal payloads all but the first become revisits that name it and keep only their headers.

Records are bytes all the way: Spark writes them as lines (the line separator being the one that
the format demands after a record) into gzip files, one archive for each task, and reads archives
back as whole files, each decompressed and cut up piece by piece.

Defined results: a null payload is empty; an empty payload is a payload like any other; a null
address becomes page:ID, white space in addresses is escaped; rows without an id come last among
equal payloads; of repeated rows one is a response; a damaged header line or a record that ends
early is returned as a problem and not converted; an empty table gives archives without records.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import read_table
from tillroll.session import materialise, scratch_path

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
WARC_VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
FILEDESC = b"filedesc://"

MAKER = "tillroll"
PAGE_HEADER = "X-Page-Id"
FIRST_DATE = datetime.datetime(2008, 1, 1)
CHUNK = 1 << 20


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Feed:
    """Lines and byte counts from an archive's content, decompressing as it goes."""

    def __init__(self, content: bytes):
        self.packed, self.taken = memoryview(content), 0
        self.gzip = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self.buffer, self.at, self.position = bytearray(), 0, 0

    def _more(self) -> bool:
        """Fetch another chunk; False at the end."""
        if self.taken >= len(self.packed) and (self.gzip is None or not self.gzip.unconsumed_tail):
            return False
        if self.gzip is None:
            data = self.packed[self.taken : self.taken + CHUNK]
            self.taken += len(data)
        else:
            tail = self.gzip.unconsumed_tail
            if not tail:
                tail = self.packed[self.taken : self.taken + CHUNK]
                self.taken += len(tail)
            data = self.gzip.decompress(tail, CHUNK)
            if self.gzip.eof:  # the next member of the file
                self.taken -= len(self.gzip.unused_data)
                self.gzip = zlib.decompressobj(31)
        del self.buffer[: self.at]
        self.at = 0
        self.buffer += data
        return True

    def read(self, count: int) -> bytes:
        while len(self.buffer) - self.at < count and self._more():
            pass
        data = bytes(self.buffer[self.at : self.at + count])
        self.at += len(data)
        self.position += len(data)
        return data

    def line(self) -> bytes | None:
        """The next line without its end; None at the end."""
        searched = self.at
        while (end := self.buffer.find(b"\n", searched)) < 0:
            known = len(self.buffer) - self.at
            if not self._more():
                break
            searched = self.at + known
        rest = (end if end >= 0 else len(self.buffer)) - self.at
        if end < 0 and rest == 0:
            return None
        data = self.read(rest + (end >= 0))
        return data.rstrip(b"\r\n")


# --- ARC ----------------------------------------------------------------------------------------


def arc_line(version: int, url: str, date: str, mime: str, length: int) -> bytes:
    """A header line, in the fields of the version."""
    start = f"{url} 0.0.0.0 {date} {mime}"
    if version == 2:
        start += " 200 - - 0 -"
    return f"{start} {length}\n".encode()


def arc_opening(version: int, name: str) -> bytes:
    """The block that opens an archive, without its last line end."""
    body = f"{version} 0 {MAKER}\n{ARC_FIELDS[version]}\n".encode()
    date = FIRST_DATE.strftime("%Y%m%d%H%M%S")
    return arc_line(version, f"filedesc://{name}", date, "text/plain", len(body)) + body


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records of an archive: offset, version, header fields, block; or offset and problem."""
    feed, version, names = Feed(content), 0, ARC_FIELDS[1].split()
    while True:
        offset = feed.position
        line = feed.line()
        if line is None:
            return
        if not line:
            continue
        if line.startswith(FILEDESC):
            names = ARC_FIELDS[1 if line.count(b" ") == 4 else 2].split()
        fields = line.decode("utf-8", "surrogateescape").rsplit(" ", len(names) - 1)
        if len(fields) != len(names) or not fields[-1].isascii() or not fields[-1].isdigit():
            yield {"offset": offset, "problem": "header line"}
            continue
        block = feed.read(int(fields[-1]))
        if len(block) < int(fields[-1]):
            yield {"offset": offset, "problem": "ends early"}
            return
        if line.startswith(FILEDESC):
            declared = block.split(b"\n")
            version = int(declared[0].split(b" ")[0])
            if len(declared) > 1 and declared[1].strip():
                names = declared[1].decode().split()
        yield {"offset": offset, "problem": None, "version": version, "block": block} | dict(
            zip(names, fields)
        )


def warc_date(digits: str) -> str:
    """ISO time of 14 digits, or of 8 to 13 with the rest taken as zeros; else the epoch."""
    try:
        moment = datetime.datetime.strptime(digits.ljust(14, "0"), "%Y%m%d%H%M%S")
    except ValueError:
        moment = datetime.datetime(1970, 1, 1)
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def split_http(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (with the empty line) and payload of an HTTP response; None for anything else."""
    if not block.startswith(b"HTTP/"):
        return None
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[: end.end()], block[end.end() :]) if end else (block, b"")


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("latin-1") if found else None


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


# --- WARC ---------------------------------------------------------------------------------------


def warc_record(kind: str, block: bytes, **fields: str | None) -> bytes:
    """A record without the last of the two line ends that follow it."""
    lines = [WARC_VERSION.decode(), f"WARC-Type: {kind}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    lines += [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}"]
    head = "\r\n".join(lines).encode("utf-8", "surrogateescape")
    return head + b"\r\n\r\n" + block + b"\r\n"


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record."""
    feed = Feed(content)
    while (line := feed.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {feed.position - len(line)}")
        fields = {}
        while line := feed.line():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = feed.read(length)
        if len(block) < length:
            raise ValueError("record ends early")
        yield fields, block


# --- tables -------------------------------------------------------------------------------------


def _write_records(records: DataFrame, path: str, line_end: str, level: str) -> None:
    """A column of bytes as gzip files, one per task, at a compression level that Hadoop names."""
    lines = records.select(F.col("record").cast("string").alias("value"))
    writer = lines.write.option("lineSep", line_end).option("compression", "gzip")
    writer.option("zlib.compress.level", level).text(path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(path).select(name.alias("archive"), "content")


def write_arc(pages: DataFrame, path: str, version: int) -> None:
    """Archives of the given version with a record for each page (page_id, url, html)."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opening = arc_opening(version, f"part-{TaskContext.get().partitionId():05d}.arc")
        yield pd.DataFrame({"record": [opening]})
        for batch in batches:
            out = []
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                has_id = not pd.isna(page_id)
                payload = html.encode("utf-8", "replace")
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if has_id:
                    head += f"{PAGE_HEADER}: {int(page_id)}\r\n"
                head += f"Content-Length: {len(payload)}\r\n\r\n"
                block = head.encode() + payload
                name = url or f"page:{int(page_id) if has_id else ''}"
                name = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", name)
                seconds = int(page_id) % 10**8 if has_id else 0
                date = FIRST_DATE + datetime.timedelta(seconds=seconds)
                digits = date.strftime("%Y%m%d%H%M%S")
                out.append(arc_line(version, name, digits, "text/html", len(block)) + block)
            yield pd.DataFrame({"record": out})

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    _write_records(rows.mapInPandas(records, "record binary"), path, "\n", "BEST_SPEED")


ARC_ROWS = (
    "archive string, offset long, problem string, version int, url string, date string, "
    "mime string, kind string, page_id long, payload_digest string, block binary"
)


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of all archives under a path; without their bytes if ``blocks`` is False."""
    columns = [c.split()[0] for c in ARC_ROWS.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                out, held = [], 0
                for record in parse_arc(content):
                    if record["problem"]:
                        out.append([archive, record["offset"], record["problem"], *[None] * 8])
                        continue
                    block, http = record["block"], split_http(record["block"])
                    kind = "response" if http else "resource"
                    if record["URL"].startswith("filedesc://"):
                        kind = "warcinfo"
                    head, payload = http or (b"", block)
                    page_id = http_field(head, PAGE_HEADER)
                    out.append(
                        [
                            archive, record["offset"], None, record["version"], record["URL"],
                            warc_date(record["Archive-date"]), record["Content-type"], kind,
                            int(page_id) if page_id else None, sha1_base32(payload),
                            block if blocks else None,
                        ]
                    )
                    held += len(block)
                    if held > 8 * CHUNK or len(out) >= 2000:
                        yield _frame(out, columns)
                        out, held = [], 0
                yield _frame(out, columns)

    return _archives(spark, path).mapInPandas(rows, ARC_ROWS)


def _frame(rows: list, columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    whole = [c for c in ("page_id", "version", "payload_bytes") if c in columns]
    return frame.astype({c: "Int64" for c in whole})


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> DataFrame:
    """Write the archives under ``arc_path`` as WARC, and return the records left out.

    Of responses whose payloads of at least ``least_bytes`` bytes are equal the one with the
    smallest page id, then archive and offset, stays whole.
    """
    narrow = materialise(read_arc(spark, arc_path, blocks=False).drop("block"), "arc-records")
    place = F.struct(F.col("page_id").isNull(), "page_id", "archive", "offset")
    responses = narrow.filter(F.col("kind") == "response")
    first = responses.groupBy("payload_digest").agg(F.min(place).alias("first"))
    # records by their place, which no key makes hot
    revisits = (
        responses.join(first, "payload_digest")
        .filter(
            (F.col("archive") != F.col("first.archive")) | (F.col("offset") != F.col("first.offset"))
        )
        .select(
            F.col("archive").alias("in_archive"),
            F.col("offset").alias("at"),
            F.col("first.archive").alias("first_archive"),
            F.col("first.offset").alias("first_offset"),
        )
    )
    same = (F.col("archive") == F.col("in_archive")) & (F.col("offset") == F.col("at"))
    rows = (
        read_arc(spark, arc_path)
        .filter(F.col("problem").isNull())
        .join(revisits, same, "left")
        .drop("in_archive", "at")
    )

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                block, kind, refers_to = row.block, row.kind, None
                payload_digest = None
                mime = row.mime
                if kind == "response":
                    head, payload = split_http(block)
                    mime = "application/http; msgtype=response"
                    payload_digest = f"sha1:{row.payload_digest}"
                    if isinstance(row.first_archive, str) and len(payload) >= least_bytes:
                        kind, block = "revisit", head
                        refers_to = record_id(row.first_archive, int(row.first_offset))
                out.append(
                    warc_record(
                        kind,
                        block,
                        WARC_Target_URI=None if kind == "warcinfo" else row.url,
                        WARC_Date=row.date,
                        WARC_Record_ID=record_id(row.archive, row.offset),
                        WARC_Payload_Digest=payload_digest,
                        WARC_Profile=REVISIT_PROFILE if kind == "revisit" else None,
                        WARC_Refers_To=refers_to,
                        Content_Type=mime,
                    )
                )
            yield pd.DataFrame({"record": out})

    records_of = rows.mapInPandas(records, "record binary")
    _write_records(records_of, warc_path, "\r\n", "DEFAULT_COMPRESSION")
    return narrow.filter(F.col("problem").isNotNull()).select("archive", "offset", "problem")


WARC_ROWS = (
    "record_id string, record_type string, url string, date string, refers_to_record string, "
    "payload_digest string, page_id long, payload_bytes long"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Header fields of the records of all archives under a path; digests of whole records are
    computed anew and must agree."""
    columns = [c.split()[0] for c in WARC_ROWS.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                out = []
                for fields, block in parse_warc(content):
                    kind = fields["warc-type"]
                    head, payload = split_http(block) or (b"", block)
                    digest = (fields.get("warc-payload-digest") or "").removeprefix("sha1:")
                    if f"sha1:{sha1_base32(block)}" != fields["warc-block-digest"] or (
                        kind == "response" and sha1_base32(payload) != digest
                    ):
                        raise ValueError(f"digest of {fields['warc-record-id']}")
                    page_id = http_field(head, PAGE_HEADER)
                    length = len(payload)
                    if kind == "revisit":
                        length = int(http_field(head, "Content-Length"))
                    out.append(
                        [
                            fields["warc-record-id"], kind, fields.get("warc-target-uri"),
                            fields["warc-date"], fields.get("warc-refers-to"), digest or None,
                            int(page_id) if page_id else None, length,
                        ]
                    )
                yield _frame(out, columns)

    return _archives(spark, path).mapInPandas(rows, WARC_ROWS)


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits, with the page that a revisit refers to."""
    pages = records.filter(F.col("record_type").isin("response", "revisit"))
    responses = records.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("response_id"), F.col("page_id").alias("refers_to")
    )
    return pages.join(responses, F.col("refers_to_record") == F.col("response_id"), "left")


def _version(page_id: Column) -> Column:
    return F.when(F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(2)) == 0, 1).otherwise(2)


def op3_legacy_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as ARC of both versions, converted to WARC and read back."""
    pages = read_table(spark, folder, "pages")
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    for version in (1, 2):
        write_arc(pages.filter(_version(F.col("page_id")) == version), f"{arc}/v{version}", version)
    convert(spark, f"{arc}/*", warc)
    records = materialise(read_warc(spark, warc), "warc-records")
    return resolved(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# The same columns from the pages themselves; SHA-1 in base 32 is spelled out five bits at a time.
OP3_SQL = """
WITH digests AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
           sha1(coalesce(html, '')) AS hex
    FROM pages
), spelled AS (
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      1 + ((('0x' || substr(hex, 1 + (5 * i) // 4, 2))::BIGINT
                            >> (3 - (5 * i) % 4)) & 31)::INT, 1)), 'string_agg', '')
               AS payload_digest
    FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM spelled
WINDOW same AS (PARTITION BY payload_digest)
"""
