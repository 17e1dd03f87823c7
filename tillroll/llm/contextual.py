"""Personal data: fixed patterns, extended by patterns bootstrapped from their contexts.

The fixed (base) kinds are seeds.  The words around them become lexical patterns: "one word
before", "two words before", and "one word before with one word after".  Identifier-like strings that are no base
match, such as a number without the plus sign, an address without a dot or with its signs written
out, are candidates.  Patterns
and the strings they surround form a graph.  In each round a pattern's confidence for a kind is the
share of strings believed to be of that kind among those that are known to be of some kind, and a
string's score follows from the patterns around it.  Strings accepted in one round are seeds of
further patterns in the next, until a round accepts none.  Strings of unknown kind do not speak
against a pattern by their number, only by its logarithm, so that a pattern is not silenced by how
many unseen identifiers it surrounds.
Candidates with a high score, and a form that suits the kind, are added: everywhere if several
contexts speak for the string, else where it stands in a confident one.  Dates are of no kind and
speak against the patterns around them.

Everything is SQL functions: matches come from regexp_extract_all, their places from the lengths of
what a split by the same pattern leaves between them.

Defined results: a null text counts as empty; a text without matches has an empty span list and
the digest of the empty string; repeated rows get equal results; a string keeps the kind it was
first accepted as; with fewer than MIN_SEEDS seeds in any context nothing is added; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import free_names, read_table, text_hash, whole_text
from tillroll.session import materialise

KINDS = ("email", "ip", "card", "phone")

# Each finds the same strings as its plain form (in the comment), with possessive repeats and a
# look-behind where a match can only start at the head of a run, so that long runs cost no
# backtracking.  \G lets a match start right after the one before.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of at least 12 digits
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# An at sign or a dot that is written out, in brackets or (the dot) between blanks.
_AT = r"(?:\x20?[(\[{]\x20?(?:[aA][tT]|@)\x20?[)\]}]\x20?|\x20[aA][tT]\x20)"
_DOT = r"(?:\.|\x20?[(\[{]\x20?(?:[dD][oO][tT]|\.)\x20?[)\]}]\x20?|\x20[dD][oO][tT]\x20)"
# "name (at) host dot org"; one with a bare "at" must spell its dot out too
WRITTEN_EMAIL = (
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?!\x20[aA][tT]\x20[A-Za-z0-9-]++\.){_AT}"
    rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"
)
# "10[.]0[.]0[.]1", "10-0-0-1", and runs of hexadecimal groups
_SEP = r"(?:\x20?[(\[{](?:\.|[dD][oO][tT])[)\]}]\x20?|[-_.]|\x20[dD][oO][tT]\x20)"
WRITTEN_IP = rf"(?<![0-9A-Za-z.+-])[0-9]{{1,3}}+(?:{_SEP}[0-9]{{1,3}}+){{3}}(?![0-9]|[-_.][0-9])"
IPV6 = r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}+|(?=::))(?::[0-9A-Fa-f]{0,4}+){2,8}+(?![0-9A-Za-z:])"
# Identifier-like strings that may turn out to be of a kind: words around an at sign, runs of
# digits with separators, and what is written in one of the forms above.
# me@localhost, without the marks around it; a local part has 64 characters at most
_PART = r"[^\x20\x09-\x0D@<>()\[\]{},;:\"'!?]"
WORD_EMAIL = rf"(?<![\p{{L}}\p{{N}}])[\p{{L}}\p{{N}}]{_PART}{{0,63}}+@{_PART}*[\p{{L}}\p{{N}}]"
# 2024-01-15, 15.1.2024 and alike: of no kind, and known to be so
DATE = r"(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:[0-9]{2}){1,2})"
CANDIDATE = (
    rf"{WORD_EMAIL}"
    rf"|{WRITTEN_EMAIL}|{WRITTEN_IP}|{IPV6}"
    r"|(?<![0-9A-Za-z.+-])\(?[0-9](?:[\x20\xA0\u2007\u2009\u202F/().-]{0,2}[0-9]){6,}+"
)
_WORD, _GAP = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
# The last two words before a match, or one if there are no more, and the first one after it.
BEFORE = rf"(?<!{_WORD}){_WORD}++(?:{_GAP}++{_WORD}++)?+{_GAP}*+$"
AFTER = rf"^{_GAP}*+{_WORD}*+"
LONG_PATTERN = 100  # characters; longer contexts are told apart by their digest
MIN_SEEDS = 3  # different seeds a pattern must surround
MIN_CONFIDENCE = 0.5  # of a pattern, to have a say
MIN_SCORE = 0.8  # of a candidate, to be added
UNKNOWN_WEIGHT = 0.25  # of the binary logarithm of how many fitting strings are of unknown kind


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sum or maximum of an array of non-negative numbers, in log2(size) passes."""
    passes = F.sequence(
        F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(2)))).cast("int")
    )

    def double(sums: Column, step: Column) -> Column:
        shifted = F.concat(F.array_repeat(F.lit(0), F.pow(F.lit(2), step).cast("int")), sums)
        return F.zip_with(sums, F.slice(shifted, 1, F.size(sums)), combine)

    return F.aggregate(passes, numbers, double)


NEAR = 64  # characters next to a match that mostly hold the words needed


def _last_words(gap: Column) -> Column:
    """The end of a text with its last two words, whole however long they are."""
    near = F.right(gap, F.lit(NEAR))
    whole = near.rlike(rf"{_GAP}{_WORD}++{_GAP}++{_WORD}++{_GAP}*+$")
    return F.when((F.length(gap) <= NEAR) | whole, near).otherwise(
        F.regexp_extract(gap, BEFORE, 0)
    )


def _first_word(gap: Column) -> Column:
    """The start of a text with its first word, whole however long it is."""
    near = F.left(gap, F.lit(NEAR))
    whole = near.rlike(rf"^{_GAP}*+{_WORD}++{_GAP}")
    return F.when((F.length(gap) <= NEAR) | whole, near).otherwise(
        F.regexp_extract(gap, AFTER, 0)
    )


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before, after) of a pattern's matches, in code points."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def placed(f: Column) -> Column:
        ends = _running(
            F.zip_with(
                f.m, F.slice(f.gaps, 1, F.size(f.m)), lambda m, gap: F.length(m) + F.length(gap)
            ),
            lambda a, b: a + b,
        )
        return _let(
            ends,
            lambda e: F.transform(
                f.m,
                lambda m, i: F.struct(
                    (F.get(e, i) - F.length(m)).alias("start"),
                    F.get(e, i).alias("end"),
                    m.alias("value"),
                    _last_words(F.get(f.gaps, i)).alias("before"),
                    _first_word(F.get(f.gaps, i + 1)).alias("after"),
                ),
            ),
        )

    return _let(found, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Doubling every second digit from the right, the digits of the results sum to tens."""
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        F.filter(digits, lambda d: d.isNotNull()),
        lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(
            short,
            lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")),
        )
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


_NONE = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def found_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, text_hash, an array of matches for each kind, and one of candidates."""
    text = whole_text(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        text_hash(text_column).alias("text_hash"),
        text.alias("t"),
        text.contains("@").alias("has_at"),
        text.rlike("[0-9][^A-Za-z]*[0-9]").alias("has_digits"),
        text.rlike(r"[(\[{]\x20?[aA][tT]\x20?[)\]}]|\x20[dD][oO][tT]\x20|::").alias("has_written"),
    )
    hints = {
        "email": F.col("has_at"),
        "ip": F.col("has_digits"),
        "card": F.col("has_digits"),
        "phone": F.col("has_digits") & F.col("t").contains("+"),
    }
    none = F.array().cast(_NONE)

    def of(kind: str) -> Column:
        good = F.filter(matches(F.col("t"), PATTERNS[kind]), lambda m: _valid(kind, m.value))
        return F.when(hints[kind], good).otherwise(none).alias(kind)

    candidates = F.when(
        F.col("has_at") | F.col("has_digits") | F.col("has_written"), matches(F.col("t"), CANDIDATE)
    ).otherwise(none)
    return rows.select(
        "doc_id", "text_hash", *[of(kind) for kind in KINDS], candidates.alias("candidates")
    )


def _occurrences(found: DataFrame) -> DataFrame:
    """A row per base match (with its kind) and per candidate that overlaps no base match."""
    from pyspark.sql import Window

    parts = [
        found.select(
            "doc_id", "text_hash", F.lit(kind).cast("string").alias("kind"), F.inline(column)
        )
        for column, kind in [*((k, k) for k in KINDS), ("candidates", None)]
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    # within a text: the furthest end of base matches that start earlier, and the next start
    in_text = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.col("kind").isNull())
    base_end = F.when(F.col("kind").isNotNull(), F.col("end"))
    base_start = F.when(F.col("kind").isNotNull(), F.col("start"))
    earlier = in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = in_text.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.distinct().withColumns(
        {
            "reached": F.max(base_end).over(earlier),
            "next_base": F.min(base_start).over(later),
        }
    )
    free = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (
        F.col("next_base").isNull() | (F.col("next_base") >= F.col("end"))
    )
    return rows.filter(F.col("kind").isNotNull() | free).drop("reached", "next_base")


def _context(column: str, which: str) -> Column:
    """Lower-case words next to a match, digits told apart only as such, without the brackets and
    marks that touch the match."""
    word = r"[^\x20\x09-\x0D]+"
    gap = r"[\x20\x09-\x0D]"
    pattern = {
        "two before": f"(?:^|{gap})({word}{gap}+{word}{gap}*)$",
        "one before": f"(?:^|{gap})({word}{gap}*)$",
        "one after": f"^({gap}*{word})(?:{gap}|$)",
    }[which]
    marks = r"^[>)\]}\"',.;:!?]++" if which == "one after" else r"[<(\[{\"']+$"
    near = F.regexp_replace(column, marks, "")
    words = F.regexp_replace(F.lower(F.regexp_extract(near, pattern, 1)), "[0-9]+", "0")
    words = F.trim(F.regexp_replace(words, f"{gap}+", " "))
    return F.when(F.length(words) > LONG_PATTERN, F.sha2(words, 256)).otherwise(words)


def _is_date(value: Column) -> Column:
    return value.rlike(f"^{DATE}$")


def _patterns() -> Column:
    """The contexts of an occurrence, from its columns ``before`` and ``after``."""
    before, after = _context("before", "one before"), _context("after", "one after")
    two = _context("before", "two before")
    return F.array_compact(
        F.array(
            F.when(before != "", F.concat(before, F.lit(" _"))),
            F.when(two != "", F.concat(two, F.lit(" _"))),
            F.when((before != "") & (after != ""), F.concat(before, F.lit(" _ "), after)),
        )
    )


def _fits(kind: Column, value: Column) -> Column:
    """Whether a candidate has a form that suits a kind."""
    n = F.length(_digits(value))
    numeric = value.rlike(r"^[^A-Za-z@:]+$") & ~_is_date(value)
    groups = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    ipv4 = value.rlike(f"^{WRITTEN_IP}$") & F.forall(groups, lambda g: g.cast("int") < 256)
    # eight groups, or fewer with one run of colons that stands for the rest
    colons = F.length(value) - F.length(F.translate(value, ":", ""))
    ipv6 = (
        value.rlike(f"^{IPV6}$")
        & value.rlike("[0-9A-Fa-f]")
        & F.when(value.contains("::"), ~value.rlike(":::|::.*::|[^:]:$")).otherwise(
            (colons == 7) & ~value.endswith(":")
        )
    )
    return (
        F.when(kind == "email", value.contains("@") | value.rlike(f"^{WRITTEN_EMAIL}$"))
        .when(kind == "ip", ipv4 | ipv6 | value.rlike(r"^[0-9]+(\.[0-9]+){3,}$"))
        .when(kind == "card", numeric & n.between(12, 19))
        .otherwise(numeric & n.between(7, 15))
    )


def bootstrap(occurrences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(value, kind, score, contexts) of the candidates that the graph of patterns supports, and
    (pattern, kind, confidence) of the patterns that are confident in the end.  ``contexts`` counts
    the different words before a string that speak for it."""
    edges = materialise(
        occurrences.select("kind", "value", F.explode(_patterns()).alias("pattern")).distinct(),
        "context-graph",
    )
    # a pattern with fewer strings than MIN_SEEDS can never have enough seeds, and one without
    # candidates has nothing to tell
    strings = edges.groupBy("pattern").agg(
        F.count("*").alias("strings"), F.count_if(F.col("kind").isNull()).alias("unseen")
    )
    telling = strings.filter((F.col("strings") >= MIN_SEEDS) & (F.col("unseen") > 0))
    open_edges = materialise(
        edges.filter(F.col("kind").isNull())
        .select("pattern", "value")
        .join(telling.select("pattern"), "pattern"),
        "open-edges",
    )
    base_seeds = materialise(
        edges.filter(F.col("kind").isNotNull())
        .join(telling.select("pattern"), "pattern", "left_semi")
        .groupBy("pattern")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"base_{k}") for k in KINDS]),
        "base-seeds",
    )
    first = -F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    accepted = None
    while True:
        state = open_edges.withColumn("kind", F.lit(None).cast("string"))
        if accepted is not None:
            state = open_edges.join(accepted.select("value", "kind"), "value", "left")
        support = _support(state, base_seeds)
        scores = (
            state.filter(F.col("kind").isNull())
            .drop("kind")
            .join(support, "pattern")
            .filter(_fits(F.col("kind"), F.col("value")))
            .groupBy("value", "kind")
            # 1 - product of (1 - confidence); rounded, so that order of summing does not show
            .agg(
                F.round(1 - F.exp(F.sum(F.log(1 - F.col("confidence")))), 9).alias("score"),
                F.count_if(F.size(F.split("pattern", " ")) == 2).alias("contexts"),
            )
        )
        best = scores.groupBy("value").agg(
            F.max(F.struct("score", first.alias("first"), "kind", "contexts")).alias("best")
        )
        best = best.select("value", "best.kind", "best.score", "best.contexts")
        found = materialise(best.filter(F.col("score") >= MIN_SCORE), "accepted")
        if accepted is not None and found.isEmpty():
            return accepted, materialise(support, "confident-patterns")
        accepted = found if accepted is None else materialise(accepted.unionAll(found), "accepted")


def _support(state: DataFrame, base_seeds: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the confident patterns, given the edges of all candidates
    with the kind of those that are accepted by now."""
    known = F.col("kind").isNotNull()
    candidates = state.groupBy("pattern").agg(
        F.count_if(_is_date(F.col("value"))).alias("dates"),
        *[F.count_if(F.col("kind") == k).alias(f"won_{k}") for k in KINDS],
        *[F.count_if(~known & _fits(F.lit(k), F.col("value"))).alias(f"open_{k}") for k in KINDS],
    )
    rows = candidates.join(base_seeds, "pattern", "left").fillna(0)
    believed = {k: F.col(f"base_{k}") + F.col(f"won_{k}") for k in KINDS}
    total = sum(believed.values(), F.col("dates"))
    kinds = F.array(
        *[
            F.struct(
                F.lit(k).alias("kind"),
                believed[k].alias("seeds"),
                F.col(f"open_{k}").alias("unknown"),
            )
            for k in KINDS
        ]
    )
    confidence = F.least(
        F.col("seeds") / (F.col("known") + UNKNOWN_WEIGHT * F.log2(1 + F.col("unknown")) + 1),
        F.lit(0.999),
    )
    return (
        rows.select("pattern", total.alias("known"), F.explode(kinds).alias("of"))
        .select("pattern", "known", "of.*")
        .filter(F.col("seeds") >= MIN_SEEDS)
        .select("pattern", "kind", confidence.alias("confidence"))
        .filter(F.col("confidence") >= MIN_CONFIDENCE)
    )


def personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_hash, base and spans; both are arrays of
    (start, rank, end) in order, rank being the place of the kind in KINDS."""
    found = materialise(found_spans(docs, id_column, text_column), "matches")
    occurrences = materialise(
        _occurrences(found.filter(F.greatest(*[F.size(c) for c in (*KINDS, "candidates")]) > 0)),
        "occurrences",
    )
    accepted, confident = bootstrap(occurrences)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("new_kind")).cast("int") - 1
    # a string that one context alone speaks for counts where it stands in such a context
    won = (
        occurrences.filter(F.col("kind").isNull())
        .select("doc_id", "text_hash", "start", "end", "value", _patterns().alias("patterns"))
        .join(accepted.withColumnRenamed("kind", "new_kind"), "value")
    )
    several = won.filter("contexts > 1").drop("patterns")
    single = won.filter("contexts <= 1").withColumn("pattern", F.explode("patterns"))
    sure = confident.select("pattern", F.col("kind").alias("new_kind"))
    single = single.join(sure, ["pattern", "new_kind"], "left_semi").drop("pattern", "patterns")
    added = (
        several.unionByName(single)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", rank.alias("rank"), "end")).alias("added"))
        .select(F.col("doc_id").alias("added_id"), F.col("text_hash").alias("added_hash"), "added")
    )

    def ranked(rank: int, kind: str) -> Column:
        return F.transform(
            kind,
            lambda m: F.struct(
                m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end")
            ),
        )

    base = F.sort_array(F.concat(*[ranked(r, kind) for r, kind in enumerate(KINDS)]))
    same = F.col("doc_id").eqNullSafe(F.col("added_id")) & (
        F.col("text_hash") == F.col("added_hash")
    )
    return (
        found.select("doc_id", "text_hash", base.alias("base"))
        .join(added, same, "left")
        .select(
            "doc_id",
            "text_hash",
            "base",
            F.when(F.col("added").isNull(), F.col("base"))
            .otherwise(F.sort_array(F.concat("base", "added")))
            .alias("spans"),
        )
    )


def span_list(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s.start, s.end)), ","
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each stretch of personal data replaced by the name of its first span's kind,
    and n_chars following the text."""
    own, of_id, of_hash, found = free_names(docs, "own_hash", "of_id", "of_hash", "found_spans")
    spans = (
        personal_data(docs)
        .filter(F.size("spans") > 0)
        .select(
            F.col("doc_id").alias(of_id),
            F.col("text_hash").alias(of_hash),
            F.col("spans").alias(found),
        )
        .dropDuplicates([of_id, of_hash])
    )
    tags = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    text = F.col("text")
    reached = _running(F.transform(found, lambda s: s.end), lambda a, b: F.greatest(a, b))

    def rebuilt(ends: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            done = F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
            kept = F.substring(text, done + 1, s.start - done)
            return F.when(s.start >= done, F.concat(kept, F.get(tags, s["rank"]))).otherwise("")

        pieces = F.array_join(F.transform(found, piece), "")
        return F.concat(pieces, F.substring(text, F.element_at(ends, -1) + 1, F.length(text)))

    new_text = F.when(F.col(found).isNull(), text).otherwise(_let(reached, rebuilt))
    hashed = docs.withColumn(own, text_hash())
    same = hashed.doc_id.eqNullSafe(spans[of_id]) & (hashed[own] == spans[of_hash])
    changed = hashed.join(spans, same, "left").withColumn("text", new_text)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn(
            "n_chars", F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(length)
        )
    return changed.select(*docs.columns)


def op4_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    rows = personal_data(read_table(spark, folder, "documents"))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return rows.select(
        "doc_id",
        *[count(r).alias(f"n_{kind}") for r, kind in enumerate(KINDS)],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
