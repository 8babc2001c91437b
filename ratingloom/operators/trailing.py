"""Counts and means over trailing time windows.

A window of N days that ends before the current moment is the difference of two running totals. Both have
frames that start at the first row, which Spark extends row by row, so the cost is linear in the rows;
a sliding frame would be summed again for every row. All frames of a key share one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.times import DAY_MS
from ratingloom.operators.skew import PIECE, KeyCuts


# What is summed up: rows, rows with a value, and the values. Sums of decimals lose no digits, however long the key,
# and a value that is no number (null, NaN, infinite) counts as a row without one.
TOTALS = ("n", "k", "s")
EXACT = "decimal(20,6)"


def _difference(days: Sequence[int], names: Mapping[int, tuple[str, str]], upto) -> dict[str, Column]:
    columns = {}
    for n in days:
        rows, known, total = (upto(0, what) - upto(n, what) for what in TOTALS)
        columns[names[n][0]] = rows
        columns[names[n][1]] = F.when(known > 0, total.cast("double") / known)
    return columns


def trailing_stats(
    df: DataFrame,
    key: str,
    at_ms: str,
    value: str,
    days: Sequence[int],
    names: Mapping[int, tuple[str, str]],
    cuts: KeyCuts | None = None,
) -> DataFrame:
    """Add count of rows and mean of `value` over [t - N days, t - 1 ms] per key; the mean is of the rows that have a
    value, null without any. Values are summed with six decimal places.

    `names[N]` gives the two column names. Rows of the same key and time never see each other.
    """
    if cuts is None:
        return _by_window(df, key, at_ms, value, days, names)
    light = _by_window(cuts.light(df), key, at_ms, value, days, names)
    return light.unionByName(_by_probes(df, key, at_ms, value, days, names, cuts))


def _by_window(df, key, at_ms, value, days, names) -> DataFrame:
    ordered = Window.partitionBy(key).orderBy(at_ms)
    exact = F.col(value).try_cast(EXACT)

    def upto(n: int, what: str) -> Column:
        frame = ordered.rangeBetween(Window.unboundedPreceding, -n * DAY_MS - 1)
        if what == "s":
            return F.coalesce(F.sum(exact).over(frame), F.lit(0))
        return F.count(F.lit(1) if what == "n" else exact).over(frame)

    return df.withColumns(_difference(days, names, upto))


def _by_probes(df, key, at_ms, value, days, names, cuts: KeyCuts) -> DataFrame:
    """Heavy keys: look every window edge up on a timeline that is cut into pieces.

    The pieces are cut anew, over the events and the window edges together: edges lie up to a window before the
    first event.
    """
    rows = cuts.only(df)
    exact = F.col(value).try_cast(EXACT)
    points = rows.groupBy(key, at_ms).agg(
        F.count(F.lit(1)).alias("__n"), F.count(exact).alias("__k"), F.coalesce(F.sum(exact), F.lit(0)).alias("__s")
    )
    edges = F.array(*[F.lit(n) for n in (0, *days)])
    probes = points.select(
        key, F.col(at_ms).alias("__owner"), F.explode(edges).alias("__days")
    ).withColumn("__at", F.col("__owner") - F.col("__days").cast("long") * DAY_MS)
    events = points.select(key, F.col(at_ms).alias("__at"), *[f"__{w}" for w in TOTALS])
    joined = events.unionByName(probes, allowMissingColumns=True)
    own = cuts.over(joined, "__at")
    timeline = own.heavy(joined, "__at")
    before = (
        Window.partitionBy(key, PIECE).orderBy("__at").rangeBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.partitionBy(key).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    sums = own.heavy(events, "__at").groupBy(key, PIECE).agg(*[F.sum(f"__{w}").alias(f"__{w}") for w in TOTALS])
    bases = own.pieces().join(sums, [key, PIECE], "left").select(
        key, PIECE, *[F.coalesce(F.sum(f"__{w}").over(earlier), F.lit(0)).alias(f"__base_{w}") for w in TOTALS]
    )
    looked_up = (
        timeline.withColumns({f"__cum_{w}": F.coalesce(F.sum(f"__{w}").over(before), F.lit(0)) for w in TOTALS})
        .where(F.col("__owner").isNotNull())
        .join(own.hinted(bases), [key, PIECE])
        .groupBy(key, F.col("__owner").alias(at_ms))
        .agg(*[
            F.max(F.when(F.col("__days") == n, F.col(f"__base_{w}") + F.col(f"__cum_{w}"))).alias(f"__{w}_{n}")
            for n in (0, *days)
            for w in TOTALS
        ])
    )
    stats = looked_up.select(
        key, at_ms, *[c.alias(a) for a, c in _difference(days, names, lambda n, w: F.col(f"__{w}_{n}")).items()]
    )
    return rows.join(stats, [key, at_ms], "left")
