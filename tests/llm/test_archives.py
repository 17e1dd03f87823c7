import base64
import gzip
import hashlib

import duckdb
from pyspark.sql import functions as F

from tillroll.llm import archives

PAGES = "page_id long, url string, html string"


def expected(rows):
    first, out = {}, []
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        seen = digest in first
        out.append((page_id, len(data), digest, "revisit" if seen else "response",
                    first[digest] if seen else None))
        first.setdefault(digest, page_id)
    return out


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, PAGES).withColumn("block", F.lit(1)).repartition(3).write.parquet(
        f"{tmp_path}/pages.parquet"
    )
    found = archives.op3_legacy_archives(spark, str(tmp_path)).collect()
    return sorted(map(tuple, found), key=key)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet')")
    found = archives.op3_legacy_archives(spark, folder).collect()
    assert sorted(map(tuple, found), key=key) == sorted(con.execute(archives.OP3_SQL).fetchall(), key=key)


def test_odd_pages(spark, tmp_path):
    trap = "WARC/1.0\r\nWARC-Type: response\r\n\r\n\nhttp://a 0.0.0.0 20080101000000 text/html 3\nabc\n\n"
    rows = [(1, "http://a b/\tc", trap), (2, None, trap), (3, "", None), (4, "x", ""), (5, "u", "é\x00\r"),
            (6, "u", "x" * 3_000_000), (7, "u", "x" * 3_000_000), (None, "n", "lone"), (8, "u", "\n\n"),
            (9, "u", " HTTP/1.1 200\r\n\r\n"), (10, "u", "HTTP/1.0 404 x\r\nX-Page-Id: 77\r\n\r\n")]
    assert run(spark, tmp_path, rows) == sorted(expected(rows), key=key)


def test_repeated_rows_and_no_rows(spark, tmp_path):
    (tmp_path / "a").mkdir()
    found = run(spark, tmp_path / "a", [(4, "u", "same")] * 3 + [(9, "v", "same")])
    assert [r[3] for r in found].count("response") == 1 and {r[4] for r in found} == {None, 4}
    (tmp_path / "b").mkdir()
    assert run(spark, tmp_path / "b", []) == []


def test_parsing_by_version_and_declared_length():
    body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\nhello\nhttp://x 1.1.1.1 2 a 3\n"
    v1 = archives.arc_opening(1, "one.arc") + b"\n" + archives.arc_line(1, "http://a/ b", "199609231421", "text/html", len(body)) + body + b"\n"
    v2 = archives.arc_opening(2, "two.arc") + b"\n" + archives.arc_line(2, "dns:x.org", "20010203040506", "text/dns", 4) + b"1234\n"
    bad = b"not a header\n"
    first, second = list(archives.parse_arc(v1)), list(archives.parse_arc(gzip.compress(v2[:300]) + gzip.compress(v2[300:] + bad)))
    assert [r["version"] for r in first] == [1, 1] and first[1]["block"] == body
    assert first[1]["URL"] == "http://a/ b" and v1[first[1]["offset"]:].startswith(b"http://a/ b")
    assert archives.warc_date(first[1]["Archive-date"]) == "1996-09-23T14:21:00Z"
    assert second[1]["block"] == b"1234" and second[1]["Result-code"] == "200"
    assert second[2]["problem"] == "header line"
    assert [r["problem"] for r in archives.parse_arc(v1[:-20])][-1] == "ends early"
    assert archives.warc_date("soon") == "1970-01-01T00:00:00Z"


def test_records_of_any_kind_are_converted(spark, tmp_path):
    (tmp_path / "arc").mkdir()
    raw = archives.arc_opening(2, "o.arc") + b"\n" + archives.arc_line(2, "dns:x.org", "20010203040506", "text/dns", 5) + b"\xff\x00\r\n1\nbroken\n"
    (tmp_path / "arc/o.arc").write_bytes(raw)
    problems = archives.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc").collect()
    assert [(p.archive, p.problem) for p in problems] == [("o.arc", "header line")]
    rows = {r.record_type: r for r in archives.read_warc(spark, f"{tmp_path}/warc").collect()}
    assert set(rows) == {"warcinfo", "resource"} and rows["resource"].payload_bytes == 5
    assert rows["resource"].date == "2001-02-03T04:05:06Z" and rows["resource"].url == "dns:x.org"
    (file,) = (tmp_path / "warc").glob("part*")
    records = list(archives.parse_warc(file.read_bytes()))
    assert records[1][1] == b"\xff\x00\r\n1" and records[1][0]["warc-record-id"] == rows["resource"].record_id
    again = archives.read_arc(spark, f"{tmp_path}/arc").filter("kind = 'resource'").first()
    assert archives.record_id("o.arc", again.offset) == rows["resource"].record_id
