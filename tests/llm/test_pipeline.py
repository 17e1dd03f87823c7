"""The pipeline against the same steps written plainly, stage by stage."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_contextual import plain_spans
from tests.llm.test_packing import PATH, ids_of
from tests.llm.test_rulelist import plain
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tillroll.llm import contextual

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before the first and after every stage."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out, columns = [docs.collect()], docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
        out.append(docs.collect())
    return out


def test_stages_are_the_named_ones():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "PII", "mixing sources to target weights", "packing"]


def test_quality(spark, steps):
    before, after = ({r.doc_id: r for r in rows} for rows in steps[:2])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    failed = set()
    for i, r in before.items():
        n, _, _, _, repeated = plain(r.text)
        if n < 20 or 100 * repeated > 30 * n:
            failed.add(i)
    assert not failed & set(after) and all(before[i] == r for i, r in after.items())
    gone = set(before) - set(after) - failed
    assert not [i for i in gone if labels.get(i) == 1]


def test_one_of_each_group_stays(steps):
    before, after = steps[1], steps[2]
    groups = plain_components(sorted((r.doc_id, plain_fingerprint(r.text)) for r in before))
    assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_personal_data_is_replaced(steps):
    before, after = ({r.doc_id: r for r in rows} for rows in steps[2:4])
    assert set(before) == set(after)
    for i, r in before.items():
        text, done, out = r.text, 0, []
        for start, kind, end in plain_spans(text):
            if start >= done:
                out += [text[done:start], f"[{contextual.KINDS[kind].upper()}]"]
            done = max(done, end)
        assert after[i].text == "".join(out) + text[done:]
        assert after[i].n_chars == len(after[i].text) and after[i].source == r.source


def test_mix(steps):
    before, after = steps[3], steps[4]
    texts, taken = {r.doc_id: r for r in before}, Counter(r.doc_id for r in after)
    assert max(taken.values()) <= 2 and all(tuple(r) == tuple(texts[r.doc_id]) for r in after)
    words = {r.doc_id: len(re.findall("[^\x20\x09-\x0d]+", r.text)) for r in before}
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in taken.items()) - 1.5 * total) < 0.1 * total


def test_packing(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    copies, pieces = Counter(r.doc_id for r in steps[4]), steps[5]
    texts = {r.doc_id: r.text for r in steps[4]}
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p.doc_id] += p.length
    assert lengths == {i: n * len(ids_of(tokenizer, texts[i])) for i, n in copies.items()}


def test_run_equals_the_stages(spark, steps):
    found = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert sorted(x[:5] for x in found) == sorted(tuple(r)[:5] for r in steps[5])


ODD_COLUMNS = ("__hash", "__id", "__row", "__copy", "__number", "own_hash", "of_id", "kept", "size", "spans", "copies", "root", "text_hash", "start", "rule", "weight", "ids")


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, docs, tmp_path, name, stage):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    long = " ".join(f"w{i % 5003}" for i in range(60_000))
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, text, None), (4, long), (5, text), (5, text), (None, text + " x"),
            (None, None), (None, None), (6, "mail a@b.cd " + text, "é")]
    table = docs(rows)
    for column in ODD_COLUMNS:
        table = table.withColumn(column, F.lit(column))
    table = table.withColumn("lang", F.lit(None).cast("string"))
    out = stage(spark, table, str(tmp_path))
    found = out.collect()
    last = (name, stage) == corpus_pipeline.STAGES[-1]
    assert found and (last or out.columns == table.columns)
    if not last:
        assert all(r[c] == c for r in found for c in ODD_COLUMNS)
        assert {r.doc_id for r in found} <= {1, 2, 3, 4, 5, 6, None}
    empty = stage(spark, table.filter("false"), str(tmp_path))
    assert empty.count() == 0 and empty.columns == out.columns
