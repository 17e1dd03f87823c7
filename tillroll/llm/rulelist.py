"""Quality rules as a learned decision list over text statistics.

Statistics of every text are computed with SQL functions.  Sequential covering then learns from the
labelled documents: a rule is grown one threshold at a time on two thirds of them, pruned on the
rest, kept if precise enough there, and the documents it covers leave before the next rule is
grown.  A rule that is not precise enough ends nothing: the next one has to start from another
feature or direction, until none is left to start from.  What comes out is an ordered CASE
expression over the statistics.

All counting is done by Spark over all labelled rows.  A step brings a count for each bin of each
feature to the driver; bins are 200 or follow a logarithm, so that there are a few thousand counts
at most, whatever the rows.

Defined results: a null or empty text has no words, fails the base rule and is not kept; labels
without a quality of 0 or 1, or of unknown documents, are ignored; a document labelled several
times counts several times; without labels of both kinds there are no learned rules, so the base
rule decides alone; repeated rows get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import WORD_GAP, free_names, read_table, text_hash, whole_text
from tillroll.session import materialise

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

MAX_CONDITIONS = 4
MIN_PRECISION = 0.9  # of a rule on the documents kept back for pruning
MIN_COVERED = 5  # rejected documents that a rule must cover there
PRUNE_ONE_IN = 3

# Monotone maps from a statistic to its bin; thresholds lie between bins.  Where a statistic has no
# upper end, bins widen with it instead of ending: each is about 4 % of the value wide.
FEATURES = {
    "length": "8 * log2(1 + n_words)",
    "word_length": "16 * log2(1 + word_chars / greatest(n_words, 1))",
    "symbol_rate": "16 * log2(1 + 100 * n_symbols / greatest(n_words, 1))",
    "mark_rate": "16 * log2(1 + 100 * n_marks / greatest(n_words, 1))",
    "upper_share": "199 * n_upper / greatest(word_chars, 1)",
    "dup_line_share": "199 * n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "199 * n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "199 * n_distinct / greatest(n_words, 1)",
}
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (*BASE_COLUMNS, "n_lines", "n_marks", "n_upper", "n_distinct")


def _paired(column: str, gap: int) -> Column:
    """Element i joined with element i + gap by hash; the last ``gap`` elements lack a partner."""
    later = F.slice(F.col(column), gap + 1, F.greatest(F.size(column), F.lit(1)))
    return F.zip_with(F.col(column), later, lambda a, b: F.xxhash64(a, b))


def text_statistics(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, text_hash and the STATISTICS (long) of every text.

    A window of eight words is told by hashing pairs of words, pairs of pairs, and pairs of
    those.  Only texts in which a window comes twice are sorted by window, to find which words
    such windows cover.
    """
    text = whole_text(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), text_hash(text_column).alias("text_hash"), text.alias("t")
    )
    rows = rows.select(
        "doc_id",
        "text_hash",
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit("[!?]")).cast("long").alias("n_marks"),
        F.regexp_count("t", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.array_remove(F.split("t", WORD_GAP), "").alias("w"),
        (F.length("t") - F.regexp_count("t", F.lit("[\\x20\\x09-\\x0D]")))
        .cast("long")
        .alias("word_chars"),
    )
    rows = rows.select(
        "doc_id",
        "text_hash",
        "n_symbols",
        "n_marks",
        "n_upper",
        "word_chars",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("w").cast("long").alias("n_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    for gap in (1, 2, 4):
        rows = rows.withColumn("h", _paired("h", gap))
    windows = F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int")
    rows = rows.withColumn("h", F.slice("h", 1, windows))
    places = F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    rows = rows.withColumn("sorted", F.when(repeats, F.sort_array(places))).drop("h")
    # neighbours with equal windows, then where such windows start
    neighbours = F.zip_with(
        "sorted",
        F.slice("sorted", 2, F.size("sorted")),
        lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)),
    )
    rows = rows.withColumn(
        "starts",
        F.sort_array(F.array_distinct(F.flatten(F.filter(neighbours, lambda x: x.isNotNull())))),
    ).drop("sorted")
    covered = F.aggregate(
        F.zip_with(
            "starts",
            F.slice("starts", 2, F.size("starts")),
            lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).select(
        "doc_id", "text_hash", *STATISTICS
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _bin(feature: str) -> Column:
    return F.floor(F.expr(FEATURES[feature])).cast("int")


@dataclass(frozen=True)
class Condition:
    """A feature's bin at or above a bound, or below it."""

    feature: str
    above: bool
    bound: int

    def on(self, value: Column) -> Column:
        return value >= self.bound if self.above else value < self.bound

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.above else '<'} {self.bound}"


Rule = tuple[Condition, ...]


def _all(conditions, column) -> Column:
    return reduce(
        lambda a, b: a & b, (c.on(column(c.feature)) for c in conditions), F.lit(True)
    )


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a document that none covers is accepted."""

    rules: tuple[Rule, ...]

    def verdict(self) -> Column:
        """CASE WHEN rule 1 THEN 1 WHEN rule 2 THEN 2 ... ELSE 0, over the statistics."""
        if not self.rules:
            return F.lit(0)
        cases = F
        for number, rule in enumerate(self.rules, 1):
            cases = cases.when(_all(rule, _bin), F.lit(number))
        return cases.otherwise(F.lit(0))

    def __str__(self) -> str:
        return "\n".join(
            " AND ".join(map(str, rule)) + f" -> reject ({number})"
            for number, rule in enumerate(self.rules, 1)
        )


def _gain(found: tuple[int, int], before: tuple[int, int]) -> float:
    """Information gained about the rejected documents, weighted by how many are still covered."""
    (bad, good), (all_bad, all_good) = found, before
    if bad == 0:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _best_condition(
    counts: dict, aside: set[tuple[str, bool]]
) -> tuple[Condition | None, tuple[int, int], float]:
    """The condition with the highest gain over {(feature, bin): (bad, good)}, but for those of a
    feature and direction set ``aside``."""
    best: tuple[Condition | None, tuple[int, int], float] = (None, (0, 0), 0.0)
    for feature in FEATURES:
        bins = sorted((b, n) for (f, b), n in counts.items() if f == feature)
        total = tuple(sum(n[i] for _, n in bins) for i in (0, 1))
        below = (0, 0)
        for (low, n), (high, _) in zip(bins, bins[1:]):
            below = (below[0] + n[0], below[1] + n[1])
            bound = (low + high + 1) // 2  # half way into a gap
            rest = (total[0] - below[0], total[1] - below[1])
            for found, is_above in ((rest, True), (below, False)):
                gain = _gain(found, total)
                if gain > best[2] + 1e-9 and (feature, is_above) not in aside:
                    best = (Condition(feature, is_above, bound), found, gain)
    return best


def _grow(rows: DataFrame, aside: set[tuple[str, bool]]) -> Rule:
    """Conditions added one by one while they shut out accepted documents; the first is none of
    those set ``aside``."""
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        cells = rows.filter(_all(rule, F.col)).select(
            "bad",
            F.explode(
                F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES])
            ).alias("cell"),
        )
        counted = cells.groupBy("cell.f", "cell.b").agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")
        )
        counts = {(r["f"], r["b"]): (r["bad"], r["good"]) for r in counted.collect()}
        condition, found, _ = _best_condition(counts, aside if not rule else set())
        if condition is None:
            break
        rule = (*rule, condition)
        if found[1] == 0:
            break
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The leading conditions that do best on held-back rows, with their (bad, good) there."""
    prefixes = [rule[:n] for n in range(1, len(rule) + 1)]
    counts = [
        F.count_if((F.col("bad") == bad) & _all(p, F.col)).alias(f"n{i}_{int(bad)}")
        for i, p in enumerate(prefixes)
        for bad in (True, False)
    ]
    found = rows.agg(*counts).first()
    scored = [(found[f"n{i}_1"], found[f"n{i}_0"], p) for i, p in enumerate(prefixes)]
    bad, good, best = max(
        scored, key=lambda s: ((s[0] - s[1]) / max(1, s[0] + s[1]), s[0], -len(s[2]))
    )
    return best, bad, good


def learn_rules(statistics: DataFrame, labels: DataFrame) -> DecisionList:
    """Rules that reject what is labelled with quality 0, among documents that pass the base."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("label_id"), (F.col("quality") == 0).alias("bad")
    )
    rows = materialise(
        statistics.filter(~base_failed())
        .join(known, F.col("doc_id") == F.col("label_id"))
        .select(
            "bad",
            (F.pmod(F.xxhash64("doc_id"), F.lit(PRUNE_ONE_IN)) == 0).alias("held_back"),
            *[_bin(f).alias(f) for f in FEATURES],
        ),
        "labelled",
    )
    rules: list[Rule] = []
    aside: set[tuple[str, bool]] = set()  # first conditions of rules that failed since the last
    while rule := _grow(rows.filter(~F.col("held_back")), aside):
        pruned, bad, good = _prune(rows.filter("held_back"), rule)
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            aside.add((rule[0].feature, rule[0].above))
            continue
        rules.append(pruned)
        aside.clear()
        rows = rows.filter(~_all(pruned, F.col))
    return DecisionList(tuple(rules))


def judged(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """text_statistics() with base_failed, the number of the rule that rejects (0: none), kept."""
    statistics = materialise(text_statistics(docs, **columns), "text-statistics")
    rules = learn_rules(statistics, labels)
    return (
        statistics.withColumn("base_failed", base_failed())
        .withColumn("rule", rules.verdict())
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the base rule nor a learned rule rejects."""
    rejected = (
        judged(docs, labels)
        .filter(~F.col("kept"))
        .select(F.col("doc_id").alias("rejected_id"), F.col("text_hash").alias("rejected_hash"))
        .distinct()
    )
    (own,) = free_names(docs, "own_hash")
    hashed = docs.withColumn(own, text_hash())
    same = hashed.doc_id.eqNullSafe(rejected.rejected_id) & (hashed[own] == rejected.rejected_hash)
    return hashed.join(rejected, same, "left_anti").select(*docs.columns)


def op7_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document."""
    rows = judged(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return rows.select("doc_id", *BASE_COLUMNS, "base_failed", "kept", "rule")
