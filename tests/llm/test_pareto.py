from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll.llm import pareto


def plain_targets(sizes):
    """Sharing by weight again and again, what is above twice the size going back."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        open_ones = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        above = [s for s in open_ones if share[s] > 2 * sizes[s]]
        if not above:
            return full | share
        for s in above:
            full[s] = 2 * sizes[s]
            left -= full[s]


def check(rows, source_of):
    sizes = defaultdict(int)
    for r in rows:
        sizes[source_of(r)] += r.size
    targets = plain_targets(sizes) if rows else {}
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    return {s: (taken[s], targets[s]) for s in sizes}


def test_targets_are_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pareto.mixed(docs).collect()
    sources = {r.doc_id: r.source for r in docs.collect()}
    for taken, target in check(rows, lambda r: sources[r.doc_id]).values():
        assert abs(taken - target) <= 0.02 * target
    again = pareto.mixed(docs.repartition(7)).collect()
    assert {r.doc_id: r.copies for r in rows} == {r.doc_id: r.copies for r in again}


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    expected = con.execute(pareto.OP6_SQL).fetchall()
    found = pareto.op6_pareto_mix(spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_odd_tables(docs):
    given = [(1, None, "a"), (2, "", "a"), (3, "x y z", None), (4, "w " * 5000, "b"), (5, "w", "c"),
             (6, "w w", "c"), (6, "w w", "c"), (None, "q r s", "c"), (None, None, None), (7, "", "empty")]
    rows = pareto.mixed(docs(given).withColumn("size", F.lit("x")).withColumn("key", F.lit(1))).collect()
    assert len(rows) == len(given)
    check(rows, lambda r: r.source)
    assert pareto.mixed(docs([])).count() == 0
    assert {r.copies * r.size for r in pareto.mixed(docs([(1, None), (2, " ")])).collect()} == {0}


def test_longer_documents_are_likelier(docs):
    given = [(i, "w " * (4 if i % 2 else 60), "a") for i in range(2000)]
    given += [(5000 + i, "w " * 60, "b") for i in range(300)]
    rows = [r for r in pareto.mixed(docs(given)).collect() if r.source == "b" or r.source == "a"]
    taken = check(rows, lambda r: r.source)
    assert all(abs(t - goal) <= 60 for t, goal in taken.values())
    mean = {n: [r.copies for r in rows if r.source == "a" and r.size == n] for n in (4, 60)}
    mean = {n: sum(c) / len(c) for n, c in mean.items()}
    assert mean[60] >= mean[4]


def test_resampled_rows_equal_the_copies(docs):
    given = [(i, f"w{i} " * (1 + i % 9), f"s{i % 4}") for i in range(300)] + [(7, "w7 " * 8, "s3")] * 3
    table = docs(given).withColumn("copies", F.lit(1))
    expected = defaultdict(int)
    for r in pareto.mixed(table).collect():
        expected[r.doc_id] += r.copies
    out = pareto.resampled(table)
    found = defaultdict(int)
    for r in out.collect():
        found[r.doc_id] += 1
    assert out.columns == table.columns and found == {i: n for i, n in expected.items() if n}


def test_repeated_rows_meet_the_targets(docs):
    """Groups of equal rows: any number of them may be taken, and exactly one is turned."""
    given, i = [], 0
    for source in range(40):
        for _ in range(30):
            given.append((i, f"d{i} " * (100 + 37 * i % 100), f"s{source:02}"))
            i += 1
        given += [(i, "same " * 40, f"s{source:02}")] * (2, 50, 7, 500)[source % 4]
        i += 1
    given += [(None, f"no id {k}", "s00") for k in range(30)]
    table = docs(given)
    rows = pareto.mixed(table).collect()
    assert len(rows) == len(given)
    for taken, target in check(rows, lambda r: r.source).values():
        assert abs(taken - target) <= 100  # half of the largest document
    again = pareto.mixed(table.repartition(9)).collect()
    counted = [sorted((str(r.doc_id), r.text_hash, r.copies) for r in run) for run in (rows, again)]
    assert counted[0] == counted[1]


def test_one_id_for_a_third_of_the_rows_is_spread(spark, docs):
    given = [(7, f"w{i % 5} " * 9, "a") for i in range(3000)] + [(i + 10, "x " * 9, "a") for i in range(6000)]
    table = docs(given)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mix, repeated = pareto._mixed(table)
        assert repeated.count() == 1 and mix.filter("doc_id = 7").select("nth").distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for taken, target in check(mix.collect(), lambda r: r.source).values():
        assert abs(taken - target) <= 9
    out = pareto.resampled(table)
    assert out.count() == sum(r.copies for r in mix.select("copies").collect())
