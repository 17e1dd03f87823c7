"""Joins and groups along time: the latest earlier row, overlapping periods, sessions.

None of them compares all rows of a key with each other, or sorts a key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.ranges import carried_last

STEP_BITS = 2  # each level of periods spans four times the one below


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    prefix: str = "",
    exact: bool = True,
) -> DataFrame:
    """Every row of ``left`` with ``values`` and the time of the latest row of ``right`` that has
    its keys and is not later (with ``exact`` false: is earlier).

    Both sides are put in one order and the last right row is carried on, in even ranges.  Rows
    without a key or a time find nothing.  Of right rows at the same time the one with the greatest
    values counts.
    """
    packed = [f"l{i}" for i in range(len(left.columns))]
    held = left.select(
        *[F.col(f"`{c}`").alias(p) for c, p in zip(left.columns, packed, strict=True)]
    )
    of = dict(zip(left.columns, packed, strict=True))
    known = F.lit(True)
    for name in (*keys, left_time):
        known &= F.col(of[name]).isNotNull()
    found = F.struct(
        F.col(right_time).alias("time"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]
    )
    given = right.dropna(subset=[*keys, right_time])
    key_names = [f"k{i}" for i in range(len(keys))]
    row_type = held.select(F.struct(*packed)).schema[0].dataType
    quotes = (
        given.groupBy(
            *[F.col(k).alias(n) for k, n in zip(keys, key_names, strict=True)],
            F.col(right_time).alias("at"),
        )
        .agg(F.max(found).alias("found"))
        .select(
            *key_names,
            "at",
            F.lit(0 if exact else 1).alias("turn"),
            "found",
            F.lit(None).cast(row_type).alias("row"),
        )
    )
    asked = held.filter(known).select(
        *[F.col(of[k]).alias(n) for k, n in zip(keys, key_names, strict=True)],
        F.col(of[left_time]).alias("at"),
        F.lit(1 if exact else 0).alias("turn"),
        F.lit(None).cast(quotes.schema["found"].dataType).alias("found"),
        F.struct(*packed).alias("row"),
    )
    carried = carried_last(quotes.unionAll(asked), key_names, ["at", "turn"], {"found": "last"})
    matched = carried.filter("row IS NOT NULL").select("row", "last")
    unmatched = held.filter(~known).select(
        F.struct(*packed).alias("row"),
        F.lit(None).cast(matched.schema["last"].dataType).alias("last"),
    )
    return matched.unionAll(unmatched).select(
        *[F.col(f"row.{p}").alias(c) for c, p in of.items()],
        F.col("last.time").alias(f"{prefix}{right_time}"),
        *[F.col(f"last.v{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)],
    )


def _days(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date")).cast("long")


def _level(start: Column, end: Column) -> Column:
    """The lowest level whose bins are at least as long as the period."""
    length = end - start + 1
    return F.ceil(F.log2(length.cast("double")) / STEP_BITS).cast("int")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_period: tuple[str, str],
    right_period: tuple[str, str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs of rows whose periods, in days with both ends counted, have a day in common and whose
    ``keys`` are equal; columns other than the keys must differ in name.

    A period goes to the level of bins that is just long enough for it, where it covers two at
    most, and is looked for at that level and at every higher one that the other side uses.  A pair
    meets at the higher of its two levels, in the bin where the common days begin, and nowhere
    else.  Periods without a start or an end, or that end before they start, overlap nothing.
    """

    def binned(df: DataFrame, period: tuple[str, str], tag: str) -> DataFrame:
        start, end = _days(period[0]), _days(period[1])
        return (
            df.withColumns({f"{tag}_from": start, f"{tag}_to": end})
            .filter(F.col(f"{tag}_from") <= F.col(f"{tag}_to"))
            .withColumn(f"{tag}_level", _level(F.col(f"{tag}_from"), F.col(f"{tag}_to")))
        )

    first, second = binned(left, left_period, "a"), binned(right, right_period, "b")

    def levels(df: DataFrame, tag: str) -> list[int]:  # a dozen numbers at most
        return sorted(r[0] for r in df.select(f"{tag}_level").distinct().collect())

    a_levels, b_levels = levels(first, "a"), levels(second, "b")

    def spread(df: DataFrame, tag: str, own: list[int], other: list[int]) -> DataFrame:
        used = F.array(*[F.lit(n) for n in sorted({*own, *other})]).cast("array<int>")
        taken = F.filter(
            used,
            lambda n: (n == F.col(f"{tag}_level"))
            | ((n > F.col(f"{tag}_level")) & F.array_contains(F.lit(other).cast("array<int>"), n)),
        )
        return df.withColumn("level", F.explode(taken)).withColumn(
            "bin",
            F.explode(
                F.sequence(
                    F.expr(f"shiftright({tag}_from, {STEP_BITS} * level)"),
                    F.expr(f"shiftright({tag}_to, {STEP_BITS} * level)"),
                )
            ),
        )

    first = spread(first, "a", a_levels, b_levels)
    second = spread(second, "b", b_levels, a_levels)
    met = first.join(second, [*keys, "level", "bin"])
    begin = F.greatest("a_from", "b_from")
    return met.filter(
        (begin <= F.least("a_to", "b_to"))
        & (F.col("level") == F.greatest("a_level", "b_level"))
        & (F.col("bin") == F.expr(f"shiftright(greatest(a_from, b_from), {STEP_BITS} * level)"))
    ).drop("level", "bin", *[f"{t}_{c}" for t in "ab" for c in ("from", "to", "level")])


def sessions(
    df: DataFrame, keys: Sequence[str], time: str, gap_seconds: int, totals: dict[str, Column]
) -> DataFrame:
    """Totals by session, as the streaming form gives them: rows of equal keys with at most
    ``gap_seconds`` between neighbours.  Rows without a time belong to none; rows without a key form
    sessions of their own, like any other key."""
    micros = gap_seconds * 1_000_000
    timed = df.filter(F.col(time).isNotNull()).withColumn("at", F.unix_micros(F.col(time)))
    seen = carried_last(timed, keys, ["at"], {"at": "previous"}, with_current=False)
    opens = F.col("previous").isNull() | (F.col("at") - F.col("previous") > micros)
    # of rows at the same time the one that opens the session comes first
    marked = seen.withColumns(
        {"opened": F.when(opens, F.col("at")), "turn": F.when(opens, 0).otherwise(1)}
    ).drop("previous")
    owned = carried_last(marked, keys, ["at", "turn"], {"opened": "session"})
    return (
        owned.groupBy(*keys, "session")
        .agg(F.max("at").alias("last"), *[total.alias(name) for name, total in totals.items()])
        .select(
            *keys,
            F.timestamp_micros("session").alias("session_start"),
            F.timestamp_micros(F.col("last") + micros).alias("session_end"),
            *totals,
        )
    )
