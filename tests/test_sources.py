"""CSV loading with quarantine, row batches, SQL pulls, writing."""

import datetime
from decimal import Decimal

import pytest

from tests.shop import shop, texts
from tillroll import session
from tillroll.sources import files
from tillroll.sources.schemas import TABLES, schema

HEADER = ",".join(name for name, _ in TABLES["customers"].columns) + "\n"


def written(tmp_path, *lines):
    path = tmp_path / "customers.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_schemas():
    assert [len(schema(t)) for t in TABLES] == [9, 10, 10, 7, 7]


def test_csv_quarantine(spark, tmp_path):
    path = written(
        tmp_path,
        'C1,"Rao, Ann",ann@example.com,Pune,MH,30,Consumer,2024-01-05,1',
        'C2,"Says ""hi""",,Delhi,DL,41,SMB,,0',
        "C3,Bad Date,c@example.com,Delhi,DL,41,SMB,2024-13-45,0",
        "C4,Bad Age,d@example.com,Delhi,DL,old,SMB,2024-01-05,1",
        "C5,Too Short",
    )
    loaded = files.read_csv(spark, path, "customers")
    good, bad = files.accepted(loaded), files.rejected(loaded)
    assert good.schema == schema("customers")
    assert texts(good.orderBy("customer_id")) == [
        "C1 Rao, Ann ann@example.com Pune MH 30 Consumer 2024-01-05 True",
        'C2 Says "hi" None Delhi DL 41 SMB None False',
    ]
    assert good.count() == 2  # a plan that needs no column at all
    assert sorted(r[files.RAW_LINE][:2] for r in bad.collect()) == ["C3", "C4", "C5"]
    # every field is checked even if the query wants only one column
    assert sorted(texts(good.select("customer_id"))) == ["C1", "C2"]


def test_csv_line_break_in_quotes(spark, tmp_path):
    path = written(
        tmp_path,
        'C1,"Ann\nRao",ann@example.com,Pune,MH,30,Consumer,2024-01-05,1',
        "C2,Bob,bob@example.com,Delhi,DL,41,SMB,2024-01-05,0",
    )
    whole = files.read_csv(spark, path, "customers", multi_line=True)
    assert files.rejected(whole).count() == 0
    assert [r["full_name"] for r in files.accepted(whole).orderBy("customer_id").collect()] == [
        "Ann\nRao",
        "Bob",
    ]
    # read line by line, the broken record is set aside, never half loaded
    split = files.read_csv(spark, path, "customers")
    assert texts(files.accepted(split), "customer_id") == ["C2"]


@pytest.mark.parametrize("table", list(TABLES))
def test_csv_round_trip(spark, tmp_path, table):
    frame = getattr(shop(spark), table)
    path = str(tmp_path / table)
    files.write_csv(frame, path)
    again = files.read_csv(spark, path, table)
    assert files.rejected(again).count() == 0
    assert sorted(texts(files.accepted(again))) == sorted(texts(frame))


def test_row_batch(spark):
    rows = [
        ("O1", "COD", 0.1 + 0.2, 1.1 * 3, 0, 3.6, "Paid"),
        ("O2", "COD", None, 0.005, 0, 1, None),
    ]
    first, second = files.load_rows(spark, rows, "payments").orderBy("order_id").collect()
    assert first["subtotal"] == Decimal("0.30") and first["tax_amount"] == Decimal("3.30")
    assert second["subtotal"] is None and second["tax_amount"] == Decimal("0.01")


def test_parse_dates(spark):
    leap_day = datetime.date(2024, 2, 29)
    fits = ["2024-02-29", "2024-02-29 00:00:00", " 2024-02-29", "2024-02-29T23:59:59.5Z", "2024-2-29 "]
    lost = ["2023-02-29", "", "2024", "not a date", "never", "2024-02-29x", "20240229"]
    text = spark.createDataFrame([(d,) for d in [*fits, None, *lost]], "d string")
    parsed = files.parse_dates(text, ["d"], misfits_as="lost").collect()
    assert [r["d"] for r in parsed] == [leap_day] * len(fits) + [None] * (1 + len(lost))
    assert [r["lost"] for r in parsed] == [[]] * (len(fits) + 1) + [["d"]] * len(lost)
    assert files.parse_dates(text, ["d"]).columns == ["d"]
    other = spark.createDataFrame([("29.02.2024",), ("2024-02-29",)], "d string")
    parsed = [r["d"] for r in files.parse_dates(other, ["d"], "dd.MM.yyyy").collect()]
    assert parsed == [leap_day, None]


def test_query_binds_values(spark):
    star = shop(spark)
    tables = {name: getattr(star, name) for name in TABLES}
    found = files.query(
        spark,
        "SELECT order_id FROM {orders} WHERE channel = :channel ORDER BY order_id",
        tables,
        channel="Mobile",
    )
    assert texts(found) == ["O3", "O5"]
    hostile = files.query(
        spark,
        "SELECT order_id FROM {orders} WHERE channel = :channel",
        tables,
        channel="x' OR '1' = '1",
    )
    assert texts(hostile) == []


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    kept = session.materialise(spark.range(3), "three")
    own = session.scratch_dir(spark)
    assert own.startswith(f"{configured}/")
    assert kept.inputFiles()[0].startswith(f"file://{own}/three-")
    assert kept.count() == 3


def test_compressed_parts_are_loaded_the_same(spark, tmp_path):
    star = shop(spark)
    for name in ("none", "gzip"):
        files.write_csv(star.orders, str(tmp_path / name), name)
    plain, packed = (files.accepted(files.read_csv(spark, str(tmp_path / n), "orders")) for n in ("none", "gzip"))
    assert list((tmp_path / "gzip").glob("part-*.csv.gz")) and not list((tmp_path / "none").glob("*.gz"))
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, packed.collect()), key=str)


def test_partitions_stay_small_unless_the_session_says_otherwise(spark):
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    session.tune(fresh)
    assert fresh.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    assert fresh.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
