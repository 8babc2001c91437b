"""Ordered work inside a key that stays bounded per task: numbering, previous rows, last known value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.times import keep_last
from ratingloom.operators.skew import PIECE, KeyCuts


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """First k rows per key in the given order, optionally with their rank.

    The rank filter becomes a group limit before the shuffle, so a hot key sends at most k rows per task.
    """
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    return top_per_key(df, keys, order, 1)


def numbered(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    name: str,
    cuts: KeyCuts | None = None,
    leading: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Position (from 1) of every row in its key.

    For heavy keys the rows are numbered inside (leading columns, piece), and each group starts after the
    sizes of the groups before it. `leading` names columns of few values that sort, descending, before the
    cut column; `descending` tells that the cut column itself sorts descending.
    """
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    if cuts is None:
        return df.withColumn(name, plain)
    groups = [key, *leading, PIECE]
    heavy = cuts.heavy(df)
    piece_order = F.desc(PIECE) if descending else F.asc(PIECE)
    earlier = (
        Window.partitionBy(key)
        .orderBy(*[F.desc(c) for c in leading], piece_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        heavy.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__start", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .drop("__rows")
    )
    inside = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    placed = (
        heavy.withColumn("__inside", inside)
        .join(starts, groups)
        .withColumn(name, (F.col("__start") + F.col("__inside")).cast("int"))
        .drop("__start", "__inside", PIECE)
    )
    return cuts.light(df).withColumn(name, plain).unionByName(placed)


def previous_rows(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    payload: Column,
    n: int,
    name: str,
    cuts: KeyCuts | None = None,
    extra: dict | None = None,
) -> DataFrame:
    """Add the payloads of the n rows before each row, oldest first.

    `extra` maps names to functions of the ordered window, evaluated in the same pass.
    """

    def add(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        found = {name: F.collect_list(payload).over(ordered.rowsBetween(-n, -1))}
        found.update({c: make(ordered) for c, make in (extra or {}).items()})
        return frame.withColumns(found)

    if cuts is None:
        return add(df, [key])
    heavy = cuts.heavy(df)
    backwards = Window.partitionBy(key, PIECE).orderBy(*[c.desc() for c in order])
    tails = (
        heavy.withColumn("__back", F.row_number().over(backwards))
        .where(F.col("__back") <= n)
        .groupBy(key, PIECE)
        .agg(F.collect_list(F.struct((-F.col("__back")).alias("pos"), payload.alias("row"))).alias("__tail"))
        .select(key, PIECE, F.transform(F.array_sort("__tail"), lambda t: t["row"]).alias("__tail"))
    )
    earlier = Window.partitionBy(key).orderBy(PIECE).rowsBetween(-n, -1)
    carried = tails.select(
        key, PIECE, keep_last(F.flatten(F.collect_list("__tail").over(earlier)), n).alias("__carried")
    )
    joined = (
        add(heavy, [key, PIECE])
        .join(cuts.hinted(carried), [key, PIECE])
        .withColumn(name, keep_last(F.concat("__carried", F.col(name)), n))
        .drop("__carried", PIECE)
    )
    return add(cuts.light(df), [key]).unionByName(joined)


def last_known(
    timeline: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    cuts: KeyCuts | None = None,
) -> DataFrame:
    """Replace `value` by the last non-null value up to and including each row of its key.

    Heavy keys are cut along the first order column.
    """

    def fill(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return frame.withColumn(value, F.last(value, ignorenulls=True).over(upto))

    if cuts is None:
        return fill(timeline, [key])
    heavy = cuts.heavy(timeline, order[0])
    last = (
        heavy.where(F.col(value).isNotNull())
        .groupBy(key, PIECE)
        .agg(F.max_by(value, F.struct(*order)).alias("__last"))
    )
    earlier = Window.partitionBy(key).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = cuts.pieces().join(last, [key, PIECE], "left").select(
        key, PIECE, F.last("__last", ignorenulls=True).over(earlier).alias("__carried")
    )
    joined = (
        fill(heavy, [key, PIECE])
        .join(cuts.hinted(carried), [key, PIECE])
        .withColumn(value, F.coalesce(F.col(value), F.col("__carried")))
        .drop("__carried", PIECE)
    )
    return fill(cuts.light(timeline), [key]).unionByName(joined)
