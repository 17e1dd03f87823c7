import random
import re

from pyspark.sql import functions as F

from tillroll.llm import rulelist


def plain(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = {}, set()
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(j for i in at for j in range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def statistics(df):
    return [(r.doc_id, *[r[c] for c in rulelist.BASE_COLUMNS]) for r in rulelist.text_statistics(df).collect()]


def test_statistics_equal_brute_force(sample_docs):
    texts = {r.doc_id: r.text for r in sample_docs.collect()}
    assert {r[0]: r[1:] for r in statistics(sample_docs)} == {i: plain(t) for i, t in texts.items()}


def test_statistics_of_odd_texts(docs):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "a\na\n \na b\na", "x " * 7, "x " * 8, "x " * 9, "ÄÖ# $a\n\n",
             "a b c d e f g h a b c d e f g h", "\r\nq\r\nq\r\n", "é" * 50_000,
             " ".join(rng.choice("abc") for _ in range(3000)),
             " ".join(f"{i % 997}" for i in range(60_000))]
    found = dict((r[0], r[1:]) for r in statistics(docs(list(enumerate(texts)))))
    assert found == {i: plain(t) for i, t in enumerate(texts)}


def test_empty_tables_and_no_labels(spark, docs, sample_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rulelist.judged(docs([]), labels).count() == 0
    rows = rulelist.judged(sample_docs.withColumn("rule", F.lit(9)), labels).collect()
    assert all(r.kept != r.base_failed and r.rule == 0 for r in rows)
    odd = spark.createDataFrame([(None, 0), (1, None), (1, 7), (-5, 1)], "doc_id long, quality int")
    assert rulelist.learn_rules(rulelist.text_statistics(sample_docs), odd).rules == ()


def test_rules_hold_on_documents_they_were_not_learned_from(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    is_test = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(4)) == 0
    stats = rulelist.text_statistics(docs).cache()
    rules = rulelist.learn_rules(stats, labels.filter(~is_test))
    assert rules.rules and all(len(r) <= rulelist.MAX_CONDITIONS for r in rules.rules)
    assert str(rules).count("reject") == len(rules.rules)
    found = (
        stats.filter(~rulelist.base_failed())
        .join(labels.filter(is_test), "doc_id")
        .select((rules.verdict() > 0).alias("out"), "quality")
        .groupBy("out", "quality").count().collect()
    )
    n = {(r["out"], r["quality"]): r["count"] for r in found}
    assert n.get((True, 1), 0) <= 0.02 * (n[True, 0] + n.get((True, 1), 0))
    assert n[True, 0] >= 0.9 * (n[True, 0] + n.get((False, 0), 0))
    stats.unpersist()


def test_rejected_documents_go(spark, docs):
    good = [(i, " ".join(f"word{i}{j}" for j in range(40))) for i in range(120)]
    bad = [(1000 + i, " ".join(f"##{i}{j}$$" for j in range(40))) for i in range(60)]
    table = docs([*good, *bad, (None, None), (None, good[0][1])]).withColumn("kept", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id long, quality int")
    left = rulelist.accepted(table, labels)
    assert left.columns == table.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids, key=lambda i: (i is None, i)) == [*range(120), None]


def test_rates_above_any_bin_are_told_apart(spark):
    """Junk whose rates lie above 200 per 100 words, next to good texts with rates just below it."""
    rows = [(i, 100, 500, 400 + i % 200 if i % 2 else 250 + i % 100, 0, 0, 10, 0, 0, 90) for i in range(600)]
    names = ["doc_id", *rulelist.STATISTICS]
    stats = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    labels = stats.select("doc_id", F.when(F.col("n_symbols") >= 400, 0).otherwise(1).alias("quality"))
    rules = rulelist.learn_rules(stats, labels)
    verdicts = stats.select("n_symbols", rules.verdict().alias("rule")).collect()
    assert len(rules.rules) == 1 and all((r.rule > 0) == (r.n_symbols >= 400) for r in verdicts)


def test_covering_goes_on_after_a_rule_that_fails(spark):
    """Nine kinds of junk told by nine thresholds, and one that the held-back rows contradict."""
    features = ["n_symbols", "n_marks", "n_upper", "n_dup_lines", "n_distinct"]
    rows, number = [], 0
    for kind in range(10):
        for k in range(120):
            value = {"n_words": 100, "word_chars": 500, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0,
                     "n_lines": 20, "n_marks": 0, "n_upper": 0, "n_distinct": 80}
            if kind < 5:
                value[features[kind]] = {"n_symbols": 60, "n_marks": 55, "n_upper": 250, "n_dup_lines": 15,
                                         "n_distinct": 10}[features[kind]]
            elif kind == 5:
                value["n_words"], value["word_chars"], value["n_distinct"] = 4000, 20000, 3200
            elif kind == 6:
                value["word_chars"] = 3000
            elif kind == 7:
                value["word_chars"] = 120
            elif kind == 8:
                value["n_repeat_words"] = 25
            rows.append((number, *[value[n] for n in rulelist.STATISTICS], int(kind == 9)))
            number += 1
        for _ in range(100):
            rows.append((number, 100, 500, 0, 0, 0, 20, 0, 0, 80, 1))
            number += 1
    names = ["doc_id", *rulelist.STATISTICS, "quality"]
    table = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    rules = rulelist.learn_rules(table.drop("quality"), table.select("doc_id", "quality"))
    wrong = table.select("quality", rules.verdict().alias("rule")).filter("(rule > 0) != (quality = 0)")
    assert len(rules.rules) > 8 and wrong.count() == 0
