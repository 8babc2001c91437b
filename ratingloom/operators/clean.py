"""Cleaning, typing, splitting and checking rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.functions.keyed import keyed_hash
from ratingloom.operators.selection import smallest

# The columns the drift check compares and their types.
DRIFT_COLUMNS = {
    "user_id": "string",
    "item_id": "string",
    "rating": "double",
    "event_ts": "timestamp_ntz",
    "main_category": "string",
    "price": "double",
}


class DataProblem(ValueError):
    """Rows break a rule the next step depends on."""


def normalise_types(df: DataFrame, ts_ms: str = "ts_ms", rating: str = "rating") -> DataFrame:
    """Epoch ms -> timestamp `event_ts` and whole seconds `ts_s`; rating -> double."""
    return df.withColumns({
        "event_ts": F.timestamp_millis(ts_ms),
        "ts_s": F.floor(F.col(ts_ms) / 1000),
        "rating": F.col(rating).cast("double"),
    })


def conform(df: DataFrame, columns: Mapping[str, str] = DRIFT_COLUMNS) -> DataFrame:
    """Exactly the named columns with lenient casts; rows with an unreadable number or time are dropped.

    A missing or null text column becomes the text 'None', so it never drops a row.
    """
    present = set(df.columns)
    picked = []
    for name, kind in columns.items():
        column = F.col(name) if name in present else F.lit(None)
        if kind == "string":
            column = F.coalesce(column.cast("string"), F.lit("None"))
        elif kind.startswith("timestamp") and name in present and isinstance(df.schema[name].dataType, T.StringType):
            column = F.try_to_timestamp(column).cast(kind)
        elif kind.startswith("timestamp"):
            column = column.cast(kind)
        else:
            column = column.try_cast(kind)
        picked.append(column.alias(name))
    return df.select(*picked).na.drop()


def fill_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add absent required columns as 0.0, then nulls: text -> '', numbers -> 0."""
    absent = {c: F.lit(0.0) for c in required if c not in df.columns}
    full = df.withColumns(absent) if absent else df
    return full.na.fill("").na.fill(0)


def split_by_source(df: DataFrame, source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(train, val) by label, without the label."""
    return tuple(df.where(F.col(source) == label).drop(source) for label in ("train", "val"))


def source_report(df: DataFrame, source: str = "source", at: str = "ts_ms") -> DataFrame:
    """Rows and time range of every source label in one pass."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(at).alias("min_" + at), F.max(at).alias("max_" + at)
    )


def split_by_time(df: DataFrame, cutoff: int | Column, at: str = "ts_ms") -> tuple[DataFrame, DataFrame]:
    """(train, val): before the cutoff, and from it on."""
    return df.where(F.col(at) < cutoff), df.where(F.col(at) >= cutoff)


def max_time(df: DataFrame, at: str = "ts_ms") -> int:
    """Newest time, one number on the driver."""
    return df.agg(F.max(at)).first()[0]


def cutoff_after(train: DataFrame, at: str = "ts_ms") -> int:
    """One second after the newest train row."""
    return max_time(train, at) + 1000


def holdout_cutoff(df: DataFrame, days: int = 30, at: str = "event_ts") -> int:
    """Epoch ms of the midnight `days` days before the newest row."""
    day = F.date_sub(F.to_date(F.max(at)), days)
    return df.agg((F.unix_seconds(day.cast("timestamp")) * 1000).alias("c")).first()["c"]


def key_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per key column, long form, one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_clean_keys(df: DataFrame, keys: Sequence[str], unique: bool = True) -> DataFrame:
    """The same rows, or DataProblem when a key column is null or (if unique) a key repeats."""
    bad = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in keys]).first().asDict()
    if any(bad.values()):
        raise DataProblem(f"null keys: {bad}")
    if unique and not duplicate_keys(df, keys).isEmpty():
        raise DataProblem(f"duplicate keys on {list(keys)}")
    return df


def exact_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups of equal rows and their size."""
    return duplicate_keys(df, columns)


def count_copies(df: DataFrame, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per group of rows equal in `columns`, null being equal to null, with its size as `copies`.

    `carry` are further columns that follow from these. One aggregate with map-side combine.
    """
    further = [F.min(c).alias(c) for c in carry]
    return df.groupBy(*columns).agg(*further, F.count(F.lit(1)).alias("copies"))


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(columns))


def binary_label(df: DataFrame, rating: str = "rating") -> DataFrame:
    return df.withColumn("label", (F.col(rating) > 0).cast("int"))


def sample_rows(df: DataFrame, n: int, seed: int, identity: Sequence[str]) -> DataFrame:
    """n rows without replacement: the n smallest keyed hashes, found by selection instead of a sort in one task."""
    key = keyed_hash(seed, *[F.col(c) for c in identity])
    leading = F.conv(F.substring(key, 1, 15), 16, 10)
    return smallest(df, n, leading, [key, *identity])


def shuffle_rows(df: DataFrame, seed: int, identity: Sequence[str]) -> DataFrame:
    """The same rows in keyed random order; `shuffle_key` is that order.

    The key is uniform, so hashing it spreads the rows evenly and no sampling pass for range bounds is
    needed; rows lie in random partitions and in random order inside each.
    """
    key = keyed_hash(seed, *[F.col(c) for c in identity])
    # the key is taken again behind the shuffle, which needn't carry it
    return df.repartition(key).withColumn("shuffle_key", key).sortWithinPartitions("shuffle_key")
