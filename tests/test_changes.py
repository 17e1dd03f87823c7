"""Stores that take batches of changes: results, untouched files, repeated runs."""

import datetime
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.changes import History, MonthStore

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("v", T.StringType())]
)


def day(month, number=1):
    return None if month is None else datetime.date(2024, month, number)


def files(path):
    return {
        os.path.join(d, f): os.path.getsize(os.path.join(d, f))
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def batch(spark, *rows):
    return spark.createDataFrame([(i, day(m), v) for i, m, v in rows], SCHEMA)


def ids(spark, *numbers):
    return spark.createDataFrame([(i,) for i in numbers], "id long")


def rows(table):
    return sorted(tuple(r) for r in table.select("id", F.month("day"), "v").collect())


def test_only_touched_months_are_written_again(spark, tmp_path):
    store = MonthStore(spark, f"{tmp_path}/store", "id", "day", SCHEMA)
    assert store.table().count() == 0
    store.apply(batch(spark, *[(i, 1 + i % 6, f"a{i}") for i in range(60)], (100, None, "no day")))
    before = files(tmp_path)
    # 7 goes from February to May, 200 is new in March, 9 in April goes
    assert sorted(map(str, store.apply(batch(spark, (7, 5, "b7"), (200, 3, "b200")), ids(spark, 9, 999)))) == [
        "2024-02-01", "2024-03-01", "2024-04-01", "2024-05-01"
    ]
    after = files(tmp_path)
    for month in ("2024-01-01", "2024-06-01", "__HIVE_DEFAULT_PARTITION__"):
        kept = {f: n for f, n in before.items() if f"month={month}" in f}
        assert kept and kept.items() <= after.items()
    want = {i: (i, 1 + i % 6, f"a{i}") for i in range(60)} | {7: (7, 5, "b7"), 200: (200, 3, "b200")}
    want.pop(9)
    found = rows(store.table().filter("day IS NOT NULL"))
    assert found == sorted(want.values())
    assert store.table().filter("day IS NULL").collect()[0].v == "no day"


def test_months_may_end_empty_and_batches_may_repeat(spark, tmp_path):
    store = MonthStore(spark, f"{tmp_path}/store", "id", "day", SCHEMA)
    store.apply(batch(spark, (1, 1, "a"), (2, 2, "b"), (3, None, "c")))
    for _ in range(2):  # the same batch again changes nothing
        store.apply(batch(spark, (1, 2, "x"), (1, 2, "w"), (None, 2, "no key")), ids(spark, 3))
        assert rows(store.table()) == [(1, 2, "x"), (2, 2, "b")]
        assert not os.path.exists(f"{tmp_path}/store/month=2024-01-01")
    assert store.apply(batch(spark), ids(spark, 77)) == []


PLAIN = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def versions(history):
    return sorted(
        (r.id, r.version, r.v, r.valid_from.month, r.valid_to and r.valid_to.month) for r in history.table().collect()
    )


def changed(spark, *pairs):
    return spark.createDataFrame(list(pairs), PLAIN)


def at(month):
    return F.lit(day(month))


def test_history_keeps_every_version(spark, tmp_path):
    history = History(spark, f"{tmp_path}/h", "id", PLAIN, buckets=4)
    history.apply(changed(spark, (1, "a"), (2, None), (3, "c")), at(1), 0)
    touched = history.apply(changed(spark, (1, "a"), (2, "b")), at(2), 1, ids(spark, 3, 99))
    assert len(touched) <= 2  # an equal row and an unknown key touch nothing
    ended = files(f"{tmp_path}/h/ended")
    history.apply(changed(spark, (3, "c"), (2, None)), at(3), 2)
    assert ended.items() <= files(f"{tmp_path}/h/ended").items()
    assert versions(history) == [
        (1, 1, "a", 1, None), (2, 1, None, 1, 2), (2, 2, "b", 2, 3), (2, 3, None, 3, None),
        (3, 1, "c", 1, 2), (3, 2, "c", 3, None),
    ]


def test_a_repeated_history_batch_changes_nothing(spark, tmp_path):
    history = History(spark, f"{tmp_path}/h", "id", PLAIN, buckets=4)
    history.apply(changed(spark, (1, "a"), (2, "b")), at(1), 0)
    for _ in range(2):
        history.apply(changed(spark, (1, "x")), at(2), 1, ids(spark, 2))
        assert versions(history) == [(1, 1, "a", 1, 2), (1, 2, "x", 2, None), (2, 1, "b", 1, 2)]
