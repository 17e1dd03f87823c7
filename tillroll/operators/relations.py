"""Comparing two loads, following hierarchies, and conditions on a row's own group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialise


def reconciled(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Where two loads of a table differ, as multisets: for each key the rows that only one has,
    counted, and the columns that differ if it is one row against one (null otherwise).

    Equal rows are counted on each side before anything is shuffled, however often they come.
    Rows that are the same on both sides cancel out; nulls equal nulls.
    """
    columns = first.columns
    sides = first.select(*columns, F.lit(1).alias("side")).unionAll(
        second.select(*columns, F.lit(-1).alias("side"))
    )
    left = sides.groupBy(*columns).agg(F.sum("side").alias("surplus")).filter("surplus <> 0")
    others = [c for c in columns if c != key]
    row = F.struct(*others)
    by_key = left.groupBy(key).agg(
        F.sum(F.greatest("surplus", F.lit(0))).alias("only_first"),
        F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("only_second"),
        F.min(F.when(F.col("surplus") > 0, row)).alias("a"),
        F.min(F.when(F.col("surplus") < 0, row)).alias("b"),
    )
    named = [F.when(~F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")), F.lit(c)) for c in others]
    single = (F.col("only_first") == 1) & (F.col("only_second") == 1)
    return by_key.select(
        key,
        "only_first",
        "only_second",
        F.when(single, F.array_join(F.array_compact(F.array(*named)), ",")).alias("changed"),
    )


def ancestors(edges: DataFrame) -> DataFrame:
    """(node, ancestor, distance) for every node of ``edges`` (node, parent), itself included.

    Distances double each round, so a hierarchy of depth d takes about log2(d) rounds, each a table
    in the shared folder.  A node has one parent at most; raises ValueError where one has more, or
    is above itself.
    """
    links = edges.filter(F.col("parent").isNotNull()).select("node", "parent").distinct()
    up = materialise(links, "parents")
    if up.groupBy("node").count().filter("count > 1").limit(1).count():
        raise ValueError("a node has several parents")
    nodes = edges.select("node").unionAll(up.select("parent")).distinct()
    known = materialise(
        nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")).unionAll(
            up.select("node", F.col("parent").alias("ancestor"), F.lit(1))
        ),
        "ancestors",
    )
    reach, total = 1, nodes.count()
    while True:
        # from the furthest ancestor known, all that it knows
        ends = known.filter(F.col("distance") == reach)
        if ends.isEmpty():
            return known
        if reach >= total:
            raise ValueError("a node is above itself")
        farther = ends.select("node", F.col("ancestor").alias("via")).join(
            known.filter("distance > 0").select(
                F.col("node").alias("via"), "ancestor", (F.col("distance") + reach).alias("distance")
            ),
            "via",
        )
        known = materialise(
            known.unionAll(farther.select("node", "ancestor", "distance")), "ancestors"
        )
        reach *= 2


def rolled_up(edges: DataFrame, amounts: DataFrame, totals: Sequence[str]) -> DataFrame:
    """``totals`` of ``amounts`` (node, ...) summed for every node over all that is below it and
    itself.  Amounts are summed by node before they meet the hierarchy."""
    own = amounts.groupBy("node").agg(*[F.sum(c).alias(c) for c in totals])
    return (
        ancestors(edges)
        .join(own, "node")
        .groupBy(F.col("ancestor").alias("node"))
        .agg(*[F.sum(c).alias(c) for c in totals])
    )


def last_above_own_mean(rows: DataFrame, group: str, order: Sequence[str], amount: str) -> DataFrame:
    """Groups whose last row, by ``order``, has a greater amount than their rows have on average:
    a condition with a subquery on the row's own group, as one aggregate.  Averages are compared as
    sums, without rounding."""
    last = F.max(F.struct(*order, F.col(amount).alias("amount")))
    found = rows.filter(F.col(group).isNotNull() & F.col(amount).isNotNull()).groupBy(group).agg(
        last.getField("amount").alias("last_amount"),
        F.sum(amount).alias("total"),
        F.count("*").alias("n"),
    )
    return found.filter(F.col("last_amount") * F.col("n") > F.col("total")).select(
        group, "last_amount", "n"
    )


def without(rows: DataFrame, others: DataFrame, key: str, null_aware: bool = False) -> DataFrame:
    """Rows whose key no row of ``others`` has.

    As NOT EXISTS: a null key matches nothing, so its row stays.  ``null_aware`` makes it NOT IN:
    with any row in ``others`` a row with a null key goes, and a null key in ``others`` leaves
    nothing.  Both are one anti join by hash or merge, never a nested loop.
    """
    keys = others.select(F.col(key).alias("other_key"))
    kept = rows.join(keys, F.col(key) == F.col("other_key"), "left_anti")
    if not null_aware:
        return kept
    some = keys.agg(
        F.count("*").alias("n"), F.count_if(F.col("other_key").isNull()).alias("nulls")
    ).first()
    if some["nulls"]:
        return rows.filter("false")
    return kept.filter(F.col(key).isNotNull()) if some["n"] else kept


def json_fields(text: Column) -> Column:
    """A JSON text as a variant, null where it is malformed."""
    return F.try_parse_json(text)


def shredded(df: DataFrame, text: str, kept: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A column of JSON objects as typed columns, and the rows whose text is malformed or no object.

    One pass finds the merged schema of all objects; the typed columns follow its fields, in
    alphabetical order.  A field that a row lacks is null.  A row without a text is an object
    without fields.
    """
    parsed = df.select(*kept, text, json_fields(F.col(text)).alias("v"))
    is_object = F.schema_of_variant("v").startswith("OBJECT")
    fits = F.coalesce(is_object, F.col(text).isNull())
    parsed = materialise(
        parsed.select("*", fits.alias("fits")).withColumn("v", F.to_json("v")), "json-rows"
    )
    found = parsed.filter("fits AND v IS NOT NULL")
    merged = found.agg(F.schema_of_variant_agg(F.parse_json("v")).alias("s")).first()["s"]
    good = parsed.filter("fits")
    if merged is not None and merged.startswith("OBJECT<"):
        fields = merged.replace("OBJECT<", "STRUCT<", 1).replace("OBJECT<", "STRUCT<")
        good = good.select(*kept, F.from_json("v", fields).alias("o")).select(*kept, "o.*")
    else:
        good = good.select(*kept)
    return good, parsed.filter("NOT fits").select(*kept, text)
