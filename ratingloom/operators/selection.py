"""Exact order statistics without a task that holds all values.

A sketch brackets each wanted rank; values below its bracket are counted, those inside it are counted one by one and
ranked by running totals over range partitions. Only a small share of the values, and ties, fall inside a bracket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.running import running_totals
from ratingloom.session import durable

ACCURACY = 10_000  # the sketch is off by at most this part of all ranks


def long_form(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """(column_name, v): the values that are not null, NaN above all others."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("v")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).where("v IS NOT NULL")


def at_ranks(values: DataFrame, ranks: Mapping[str, Sequence[int]], sizes: Mapping[str, int]) -> dict[tuple[str, int], object]:
    """The value at each rank, from 0, of the ascending values of each name in `values` (column_name, v)."""
    wanted = sorted({(name, r) for name, all_ranks in ranks.items() for r in all_ranks})
    found: dict[tuple[str, int], object] = {}
    slack = 2 / ACCURACY
    while len(found) < len(wanted):
        open_ = [(name, r) for name, r in wanted if (name, r) not in found]
        shares = sorted({min(1.0, max(0.0, (r + 0.5) / sizes[name] + s)) for name, r in open_ for s in (-slack, slack)})
        sketch = values.groupBy("column_name").agg(
            F.percentile_approx("v", shares, ACCURACY).alias("q"), F.min("v").alias("low"), F.max("v").alias("high")
        ).collect()  # one row per column
        edges = {r.column_name: dict(zip(shares, r.q)) | {"low": r.low, "high": r.high} for r in sketch}
        brackets = []
        for name, r in open_:
            low, high = ((r + 0.5) / sizes[name] + s for s in (-slack, slack))
            mine = edges[name]
            brackets.append((name, r, mine["low"] if low <= 0 else mine[low], mine["high"] if high >= 1 else mine[high]))
        kind = dict(values.dtypes)["v"]
        table = values.sparkSession.createDataFrame(brackets, f"column_name string, rank long, low {kind}, high {kind}")
        joined = values.join(F.broadcast(table), "column_name")  # as many rows as ranks are wanted
        below = joined.groupBy("column_name", "rank").agg(F.count_if(F.col("v") < F.col("low")).alias("below"))
        inside = joined.where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high"))).groupBy("column_name", "rank", "v").agg(
            F.count(F.lit(1)).alias("n")
        )
        ranked = running_totals(inside, ["v"], {"n": F.col("n")}, ["column_name", "rank"])
        first = F.col("below") + F.col("before_n")
        hit = (first <= F.col("rank")) & (F.col("rank") < first + F.col("n"))
        got = ranked.join(F.broadcast(below), ["column_name", "rank"]).where(hit).collect()  # one row per rank at most
        found |= {(r.column_name, r.rank): r.v for r in got}
        slack *= 100  # a bracket missed its rank: a wider one, in the end all values
    return found


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of numeric columns, linear between neighbours; None for a column without values."""
    values = long_form(df, columns)
    counted = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per column
    sizes = {r.column_name: r.n for r in counted}
    places = {name: [share * (n - 1) for share in shares] for name, n in sizes.items()}
    ranks = {name: sorted({int(p) for p in all_} | {min(sizes[name] - 1, int(p) + 1) for p in all_}) for name, all_ in places.items()}
    found = at_ranks(values, ranks, sizes) if sizes else {}
    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = [None] * len(shares)
        for i, p in enumerate(places.get(c, [])):
            low, high = found[c, int(p)], found[c, min(sizes[c] - 1, int(p) + 1)]
            out[c][i] = low + (p - int(p)) * (high - low) if p > int(p) else low
    return out


def smallest(df: DataFrame, n: int, key: Column, order: Sequence[str | Column]) -> DataFrame:
    """The n rows of smallest (key, order); `key` is a whole number, and rows that share the last one are few.

    The n-th smallest key is found first; rows below it stay where they are, and only those at it are sorted.
    """
    keyed = df.withColumn("__n_key", key.cast("long"))
    total = keyed.count()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    last = at_ranks(long_form(keyed, ["__n_key"], "long"), {"__n_key": [n - 1]}, {"__n_key": total})["__n_key", n - 1]
    below = keyed.where(F.col("__n_key") < last)
    at = keyed.where(F.col("__n_key") == last).orderBy(*order).limit(n - below.count())
    return below.unionByName(at).drop("__n_key")
