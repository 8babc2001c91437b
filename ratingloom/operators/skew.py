"""Keys too large for one task: find them and cut their ordered rows into bounded pieces.

Ordered operators (trailing windows, histories, as-of lookups, numbering) partition by key. A key with more rows
than a task should sort is cut at quantiles of the sort column. Each piece runs as its own window partition,
and what a piece needs from earlier ones (a running total, the last rows, the last value) is carried over by a
pass over a few rows per piece. Results are the same with and without cuts; only the physical layout differs.

A piece aims at a fixed number of rows, whatever the size of the table, so tasks stay alike when it grows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.session import durable

PIECE = "__piece"
MIN_ROWS_CONF = "spark.ratingloom.skew.minRows"
DEFAULT_MIN_ROWS = 5_000_000  # rows of a piece
MAX_PIECES = 10_000  # of one key
BROADCAST_CUTS = 500_000  # keys and cuts up to which the cut table is sent to every task


@dataclass(frozen=True)
class KeyCuts:
    """Cut points per heavy key. `table` has one row per heavy key: key, __cuts (ascending array<bigint>)."""

    key: str
    order: str
    table: DataFrame
    small: bool
    min_rows: int

    def hinted(self, df: DataFrame) -> DataFrame:
        """A frame of a few rows per cut, for a join: broadcast if the number of cuts allows it."""
        return F.broadcast(df) if self.small else df

    def heavy(self, df: DataFrame, order: str | None = None) -> DataFrame:
        """Rows of heavy keys with their piece number; equal sort values share a piece."""
        at = F.col(order or self.order)
        piece = F.size(F.filter("__cuts", lambda cut: cut <= at))
        return df.join(self.hinted(self.table), self.key).withColumn(PIECE, piece).drop("__cuts")

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of heavy keys."""
        return df.join(self.hinted(self.table.select(self.key)), self.key)

    def light(self, df: DataFrame) -> DataFrame:
        return df.join(self.hinted(self.table.select(self.key)), self.key, "left_anti")

    def pieces(self) -> DataFrame:
        """All (key, piece) pairs, empty pieces included."""
        every = F.sequence(F.lit(0), F.size("__cuts"))
        return self.table.select(self.key, F.explode(every).alias(PIECE))

    def over(self, df: DataFrame, order: str) -> KeyCuts:
        """Cuts of the same keys for other rows of theirs, by their own number and order."""
        sizes = df.groupBy(self.key).agg(F.count(F.lit(1)).alias("__rows"))
        return _cut(df, self.key, order, durable(sizes), self.min_rows)


def piece_rows(df: DataFrame, min_rows: int | None = None) -> int:
    return min_rows or int(df.sparkSession.conf.get(MIN_ROWS_CONF, str(DEFAULT_MIN_ROWS)))


def _heavy_sizes(df: DataFrame, key: str, min_rows: int) -> DataFrame | None:
    """(key, __rows) of the keys with more than `min_rows` rows; None if there is none."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    heavy = durable(sizes.where(F.col("__rows") > min_rows))
    return None if heavy.isEmpty() else heavy


def heavy_keys(df: DataFrame, key: str, min_rows: int | None = None) -> DataFrame | None:
    """The heavy keys, to be joined on; None if there is none. One pass with map-side combine."""
    sizes = _heavy_sizes(df, key, piece_rows(df, min_rows))
    if sizes is None:
        return None
    keys = sizes.select(key)
    return F.broadcast(keys) if sizes.count() <= BROADCAST_CUTS else keys


def _cut(df: DataFrame, key: str, order: str, sizes: DataFrame, min_rows: int) -> KeyCuts:
    wanted = F.least(F.ceil(F.col("__rows") / min_rows), F.lit(MAX_PIECES))
    largest, keys, cuts = sizes.agg(F.max(wanted), F.count(F.lit(1)), F.sum(wanted)).first()
    small = keys + cuts <= BROADCAST_CUTS
    pieces = max(2, int(largest or 0))
    shares = [i / pieces for i in range(1, pieces)]
    rows = df.select(key, F.col(order).cast("long").alias("__at"))
    own = sizes.select(key, wanted.cast("int").alias("__wanted"))
    quantiles = (
        rows.join(F.broadcast(own) if small else own, key)
        .groupBy(key)
        .agg(
            F.percentile_approx("__at", shares, max(10_000, 2 * pieces)).alias("__q"),
            F.first("__wanted").alias("__wanted"),
        )
    )
    # a smaller key takes every so many of the quantiles of the largest
    step = F.greatest(F.floor(F.lit(pieces) / F.col("__wanted")), F.lit(1))
    every = F.filter("__q", lambda _, i: (i + 1) % step == 0)
    table = quantiles.select(key, F.when(F.col("__wanted") > 1, F.array_sort(F.array_distinct(every))).otherwise(
        F.array().cast("array<bigint>")).alias("__cuts"))
    return KeyCuts(key, order, durable(table), small, min_rows)


def find_cuts(
    df: DataFrame, key: str, order: str, min_rows: int | None = None, counted: DataFrame | None = None
) -> KeyCuts | None:
    """Cut points for keys above `min_rows` rows; None if there is no such key.

    Runs one counting pass with map-side combine; only when it finds a heavy key, a second one over those rows.
    Keys and cuts stay a table: about one row or cut per `min_rows` rows, broadcast up to BROADCAST_CUTS. `counted`
    may name a cheaper frame with the same keys, when df is costly to compute: cuts only shape the layout, so they
    need not be exact.
    """
    rows = piece_rows(df, min_rows)
    sizes = _heavy_sizes(df if counted is None else counted, key, rows)
    return None if sizes is None else _cut(df, key, order, sizes, rows)
