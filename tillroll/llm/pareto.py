"""Mixing sources to target sizes by Pareto order sampling.

Each source has a target in words.  Within a source every document has an expected number of
copies, proportional to a weight and at most MAX_COPIES, that adds up to the target.  Its whole part
is taken for certain.  The rest of it is an inclusion probability p: documents are ranked by the
odds of a uniform number of their own divided by the odds of p, and the leading ones are taken
until the words still missing are filled.  The sample so has a fixed size in words; the document on
the edge comes in if that is nearer to the target, and one more document comes in or goes if its
size makes up for most of what is then missing or too much.

Running sums over a whole source never meet in one task: the edge is found digit by digit, by sums
over at most 4096 groups of rank keys, and only the documents whose keys share 36 bits with it are
sorted.

Defined results: a null text has no words; a null source is a source of its own, last in order; a
source without words has target 0; an empty document takes 0 words whatever its copies; equal
rows are counted through and ranked each for itself, so any of them may be taken and any not; an
empty table gives no rows.  Reruns agree, equal rows standing for each other: the uniform numbers
are digests of the id, and of a row's number among those that share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import numbered, read_table, text_hash, whole_text
from tillroll.session import materialise

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_COPIES = 2
SALT = "mix"
KEY_BITS = 52
DIGIT_BITS = 12
DIGITS = 3


def filled_to(
    total: Column, cap: Column, weight: Column, by: Sequence[str], last: Column
) -> Column:
    """The level at which least(cap, level * weight) adds up to ``total``, over the rows of
    ``by``.  Rows fill up in order of cap / weight; with the first k full, the others share what
    is left by weight.  That share grows with k as long as full rows belong there, then falls, so
    the level is the largest share; the share for the row's own place is returned."""
    whole = Window.partitionBy(*by)
    in_order = whole.orderBy(F.try_divide(cap, weight), last)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum(cap).over(earlier), F.lit(0.0))
    closed = F.coalesce(F.sum(weight).over(earlier), F.lit(0.0))
    return F.try_divide(total - full, F.sum(weight).over(whole) - closed)


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """source, source_size, target from (source, source_size): a row per source.

    Sources in order of code points, null last, have the weights in turn.
    """
    ranked = sizes.withColumn(
        "rank",
        F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1,
    )
    cap = (max_copies * F.col("source_size")).cast("double")
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int"))
    rows = ranked.select(
        "source", "source_size", "rank", cap.alias("cap"), weight.cast("double").alias("weight")
    )
    total = F.sum("source_size").over(Window.partitionBy()) * share_percent / F.lit(100.0)
    share = filled_to(total, F.col("cap"), F.col("weight"), [], F.col("rank"))
    level = F.max("share").over(Window.partitionBy())
    return rows.withColumn("share", share).select(
        "source", "source_size", F.least("cap", F.col("weight") * level).alias("target")
    )


def _uniform(id_column: str, nth: str, salt: str) -> Column:
    """A number above 0 and below 1, from the digest of the id, and of a repeated id's number."""
    named = F.concat(
        F.lit(f"{salt}:"),
        F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
        F.when(F.col(nth) > 0, F.concat(F.lit(":"), nth)).otherwise(""),
    )
    digits = F.conv(F.substring(F.md5(named.cast("binary")), 1, KEY_BITS // 4), 16, 10)
    return (digits.cast("long") + 0.5) / F.lit(float(2**KEY_BITS))


def _numbered_ids(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``rows`` (id, hash, src and more) with ``nth``, counting from 0 the rows that share an id, in
    order of hash and source.  Only those of ``repeated`` ids are sorted, in even ranges however
    often an id comes."""
    first = F.lit(0).cast("long").alias("nth")
    if repeated is None:
        return rows.select("*", first)
    same = rows["id"].eqNullSafe(repeated["again"])
    many = rows.join(repeated, same, "left_semi").withColumn("salt", F.rand())
    placed = numbered(many, ["id", "hash", "src", "salt"], "repeated-ids").drop("salt", "total")
    starts = placed.groupBy(F.col("id").alias("of_id")).agg(F.min("position").alias("start"))
    placed = placed.join(starts, F.col("id").eqNullSafe(F.col("of_id")))
    placed = placed.withColumn("nth", F.col("position") - F.col("start"))
    return rows.join(repeated, same, "left_anti").select("*", first).unionByName(
        placed.drop("of_id", "start", "position")
    )


def _repeated(ids: DataFrame) -> DataFrame | None:
    """The values of ``id`` that more than one row has (as ``again``), None if there are none."""
    counted = ids.groupBy(F.col("id").alias("again")).agg(F.count("*").alias("n"))
    again = materialise(counted.filter("n > 1").select("again"), "repeated")
    return None if again.isEmpty() else again


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
    salt: str = SALT,
) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, copies: a row per row of ``docs``.

    Documents weigh as many units as the binary length of their size, so that long documents are
    somewhat likelier to be taken, in proportion to the logarithm of their length.
    """
    return _mixed(docs, weights, share_percent, max_copies, salt)[0].drop("nth")


def _mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
    salt: str = SALT,
) -> tuple[DataFrame, DataFrame | None]:
    """The mix with the number ``nth`` of each row among those of its id, and the repeated ids."""
    sizes = materialise(
        docs.select(
            F.col("doc_id").alias("id"),
            text_hash().alias("hash"),
            F.col("source").cast("string").alias("src"),
            F.regexp_count(whole_text(), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size"),
        ),
        "sizes",
    )
    repeated = _repeated(sizes)
    rows = _numbered_ids(sizes, repeated).select(
        F.col("id").alias("doc_id"),
        F.col("hash").alias("text_hash"),
        F.col("src").alias("source"),
        "size",
        F.length(F.bin("size")).alias("weight"),
        "nth",
    )
    if repeated is not None:
        rows = materialise(rows, "numbered-rows")
    # expected copies for each weight of each source: at most 64 rows per source
    classes = rows.groupBy("source", "weight").agg(F.sum("size").alias("class_size"))
    targets = source_targets(
        classes.groupBy("source").agg(F.sum("class_size").alias("source_size")),
        weights,
        share_percent,
        max_copies,
    ).withColumnRenamed("source", "of")
    classes = classes.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    mass = F.col("weight").cast("double") * F.col("class_size")
    classes = classes.withColumns(
        {"mass": mass, "cap": (max_copies * F.col("class_size")).cast("double")}
    )
    rate = filled_to(F.col("target"), F.col("cap"), F.col("mass"), ["source"], F.col("weight"))
    classes = classes.withColumn("rate", rate)
    level = F.max("rate").over(Window.partitionBy("source"))
    expected = F.coalesce(F.least(F.lit(float(max_copies)), level * F.col("weight")), F.lit(0.0))
    classes = materialise(
        classes.select(
            F.col("source").alias("of"),
            F.col("weight").alias("of_weight"),
            "class_size",
            "source_size",
            "target",
            expected.alias("expected"),
        ),
        "expected-copies",
    )
    needed = classes.groupBy("of").agg(
        F.max("target").alias("t"),
        F.sum(F.floor("expected") * F.col("class_size")).alias("certain_words"),
    )
    needed = needed.select("of", (F.col("t") - F.col("certain_words")).alias("missing"))

    # documents, by the odds of their own number over the odds of inclusion
    u, p = F.col("u"), F.col("p")
    low, high = u * (1 - p), (1 - u) * p
    class_rows = classes.select("of", "of_weight", "source_size", "target", "expected")
    ranked = materialise(
        rows.join(
            class_rows,
            F.col("source").eqNullSafe(F.col("of")) & (F.col("weight") == F.col("of_weight")),
            "left",
        )
        .withColumns(
            {
                "certain": F.coalesce(F.floor("expected"), F.lit(0)).cast("int"),
                "p": F.coalesce(F.col("expected") - F.floor("expected"), F.lit(0.0)),
                "u": _uniform("doc_id", "nth", salt),
            }
        )
        .select(
            "doc_id",
            "nth",
            "text_hash",
            "source",
            "size",
            "source_size",
            "target",
            "certain",
            F.when((p > 0) & (F.col("size") > 0), F.floor(low / (low + high) * 2.0**KEY_BITS))
            .cast("long")
            .alias("key"),
        ),
        "ranked",
    )
    edge = _edges(ranked.filter(F.col("key").isNotNull()), needed)
    return _taken(ranked, edge), repeated


def _edges(ranked: DataFrame, needed: DataFrame) -> DataFrame:
    """of, missing, prefix, before: for each source the leading DIGITS of the key at which the
    missing words are reached (null where all documents are needed), and the words before it."""
    zero = F.lit(0).cast("long")
    edge = needed.select("of", "missing", zero.alias("prefix"), zero.alias("before"))
    key_digits = KEY_BITS
    for _ in range(DIGITS):
        upper, key_digits = key_digits, key_digits - DIGIT_BITS
        groups = (
            ranked.join(
                edge,
                F.col("source").eqNullSafe(F.col("of"))
                & (F.shiftright("key", upper) == F.col("prefix")),
            )
            .groupBy("of", F.shiftright("key", key_digits).alias("digits"))
            .agg(
                F.sum("size").alias("words"),
                F.max("missing").alias("missing"),
                F.max("before").alias("start"),
            )
        )
        until = Window.partitionBy("of").orderBy("digits")
        groups = groups.withColumn(
            "reached",
            F.col("start")
            + F.sum("words").over(until.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        found = (
            groups.filter(F.col("reached") >= F.col("missing"))
            .groupBy("of")
            .agg(
                F.min(F.struct("digits", (F.col("reached") - F.col("words")).alias("b"))).alias("x")
            )
            .select(
                F.col("of").alias("edge_of"), F.col("x.digits").alias("p"), F.col("x.b").alias("b")
            )
        )
        edge = materialise(
            needed.join(found, F.col("of").eqNullSafe(F.col("edge_of")), "left").select(
                "of",
                "missing",
                F.col("p").alias("prefix"),
                F.coalesce("b", F.lit(0)).cast("long").alias("before"),
            ),
            "edge",
        )
    return edge


def _taken(ranked: DataFrame, edge: DataFrame) -> DataFrame:
    """Copies of each document, given the edges."""
    shift = KEY_BITS - DIGITS * DIGIT_BITS
    place = F.shiftright("key", shift)
    rows = ranked.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    # on the edge, in rank order; those elsewhere get a partition of their own digits
    is_edge = F.col("key").isNotNull() & (place == F.col("prefix"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size", "nth")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.col("before") + F.sum("size").over(order)
    over = F.col("reached") - F.col("missing")
    on_edge = (
        rows.filter(is_edge)
        .withColumn("reached", reached)
        .withColumn("chosen", (over <= 0) | (over < F.col("size") - over))
        .drop("reached")
    )
    elsewhere = rows.filter(~F.coalesce(is_edge, F.lit(False))).withColumn(
        "chosen", F.col("key").isNotNull() & (F.col("prefix").isNull() | (place < F.col("prefix")))
    )
    rows = materialise(elsewhere.unionByName(on_edge), "chosen")
    # one document per source, of a size nearest to what is missing or too much, comes in or goes
    words = F.coalesce(F.sum(F.when(F.col("chosen"), F.col("size"))), F.lit(0))
    gaps = (
        rows.groupBy("source")
        .agg((F.max("missing") - words).alias("gap"))
        .select(F.col("source").alias("of"), "gap")
    )
    off = F.abs(F.abs("gap") - F.col("size"))
    last = (
        rows.filter(F.col("key").isNotNull())
        .join(gaps, F.col("source").eqNullSafe(F.col("of")))
        .filter((F.col("chosen") == (F.col("gap") < 0)) & (off < F.abs("gap")))
        .groupBy("of")
        .agg(F.min(F.struct(off.alias("off"), "key", "doc_id", "nth")).alias("x"))
        .select("of", F.col("x.doc_id").alias("last_id"), F.col("x.nth").alias("last_nth"))
    )
    fits = (
        F.col("source").eqNullSafe(F.col("of"))
        & F.col("doc_id").eqNullSafe(F.col("last_id"))
        & (F.col("nth") == F.col("last_nth"))
        & F.col("key").isNotNull()
    )
    turned = F.col("last_nth").isNotNull()
    copies = F.col("certain") + (F.col("chosen") != turned).cast("int")
    return rows.join(last, fits, "left").select(
        "doc_id",
        "nth",
        "text_hash",
        "source",
        "size",
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        copies.alias("copies"),
    )


def resampled(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    mix, repeated = _mixed(docs, **options)
    taken = mix.filter(F.col("copies") > 0).select(
        F.col("doc_id").alias("of_id"), F.col("nth").alias("of_nth"), "copies"
    )
    rows = _numbered_ids(
        docs.select(
            F.struct("*").alias("doc"),
            F.col("doc_id").alias("id"),
            text_hash().alias("hash"),
            F.col("source").cast("string").alias("src"),
        ),
        repeated,
    )
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("nth") == F.col("of_nth"))
    copied = rows.join(taken, same).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return copied.select("doc.*")


# The same mix for tables without repeated ids: all ranks are sorted at once instead of by digits.
OP6_SQL = """
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
    FROM documents
), by_source AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked_sources AS (
    SELECT *, (2 * source_size)::DOUBLE AS cap,
           [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM by_source
), shares AS (
    SELECT *, (sum(source_size) OVER () * 1.5 - coalesce(sum(cap) OVER earlier, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS share
    FROM ranked_sources
    WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(cap, weight * max(share) OVER ()) AS target FROM shares
), weighed AS (
    SELECT *, length(bin(size)) AS weight FROM sized
), classes AS (
    SELECT w.source, w.weight, sum(w.size)::DOUBLE AS class_size, t.source_size, t.target
    FROM weighed w JOIN targets t ON w.source IS NOT DISTINCT FROM t.source
    GROUP BY ALL
), rates AS (
    SELECT *, (target - coalesce(sum(2 * class_size) OVER earlier, 0))
           / nullif(sum(weight * class_size) OVER (PARTITION BY source)
                    - coalesce(sum(weight * class_size) OVER earlier, 0), 0) AS rate
    FROM classes
    WINDOW earlier AS (PARTITION BY source
                       ORDER BY CASE WHEN class_size > 0 THEN 2 * class_size / (weight * class_size)
                                END NULLS FIRST, weight
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), copies AS (
    SELECT *, coalesce(least(2.0::DOUBLE, max(rate) OVER (PARTITION BY source) * weight), 0) AS e
    FROM rates
), keyed AS (
    SELECT w.doc_id, w.source, w.size, c.source_size, c.target,
           floor(c.e)::BIGINT AS certain, c.e - floor(c.e) AS p,
           (('0x' || substr(md5('mix:' || coalesce(w.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
            + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM weighed w JOIN copies c ON w.source IS NOT DISTINCT FROM c.source AND w.weight = c.weight
), ordered AS (
    SELECT *, CASE WHEN p > 0 AND size > 0
                   THEN floor(u * (1 - p) / (u * (1 - p) + (1 - u) * p)
                              * 4503599627370496::DOUBLE)::BIGINT END AS key,
           target - sum(certain * size) OVER (PARTITION BY source) AS missing
    FROM keyed
), summed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                              ROWS UNBOUNDED PRECEDING) AS reached
    FROM ordered WHERE key IS NOT NULL
), chosen AS (
    SELECT doc_id, reached <= missing
           OR (reached - size < missing AND reached - missing < size - (reached - missing)) AS hit
    FROM summed
), states AS (
    SELECT o.*, coalesce(c.hit, FALSE) AS hit,
           missing - sum(CASE WHEN c.hit THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap
    FROM ordered o LEFT JOIN chosen c ON o.doc_id = c.doc_id
), turned AS (
    SELECT doc_id FROM states
    WHERE key IS NOT NULL AND hit = (gap < 0) AND abs(abs(gap) - size) < abs(gap)
    QUALIFY row_number() OVER (PARTITION BY source
                               ORDER BY abs(abs(gap) - size), key, doc_id) = 1
)
SELECT doc_id, size, source_size, target,
       ((certain + (hit <> (doc_id IN (SELECT doc_id FROM turned)))::INT) * size)::BIGINT AS taken
FROM states
"""


def op6_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The words that the mix takes of every document."""
    rows = mixed(read_table(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)
