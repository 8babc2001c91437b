"""The training set: positives and negatives with features as of their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.asof import asof_attach
from ratingloom.operators.clean import require_clean_keys, shuffle_rows
from ratingloom.operators.joins import many_to_one
from ratingloom.operators.ordered import first_per_key
from ratingloom.operators.sampling import negative_samples
from ratingloom.plans.feature_job import ITEM_STAT_COLUMNS
from ratingloom.session import durable

SEED = 41
TTL_DAYS = 10_000


def training_table(
    positives: DataFrame,
    item_stats: DataFrame,
    metadata: DataFrame,
    user_columns: Sequence[str] = (),
    ratio: int = 1,
    seed: int = SEED,
    ttl_days: int = TTL_DAYS,
    stat_columns: Sequence[str] = tuple(ITEM_STAT_COLUMNS),
    users: DataFrame | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Positives and their negatives with item metadata and item statistics as of the row's time, shuffled.

    `positives`: user_id, item_id, rating, ts_ms and `user_columns`, which negatives copy. Negatives have
    rating 0 and the positive's time. `item_stats` is unique in (item_id, ts_ms). With `users` (user_id, ts_ms and
    `user_columns`) these are looked up there for either kind of row, and positives, which are read several times,
    don't hold them; every user and time of the positives must be there. Columns that are `required` must not be null.
    """
    columns = ["user_id", "item_id", "rating", "ts_ms"]
    own = [*columns, "__positive"] if user_columns and users is None else columns
    if users is None:
        kept = durable(positives.select(*columns, *user_columns).withColumn("__positive", F.monotonically_increasing_id()))
    else:
        kept = positives
    # what negatives copy is put on at the end: draws and lookups carry its number alone
    narrow = kept.select(*own)
    carried = [c for c in own if c in ("ts_ms", "__positive")]
    negatives = negative_samples(narrow, ["user_id", "item_id", "ts_ms"], carried=carried, ratio=ratio, seed=seed)
    # nothing wide is kept: what is put on later neither adds rows nor changes these columns
    rows = checked(narrow.unionByName(negatives.select(*own)), required)
    found = asof_attach(rows, item_stats, "item_id", "ts_ms", list(stat_columns), ttl_days, counted=rows)
    full = many_to_one(found, metadata, ["item_id"])
    if users is not None:
        full = full.join(users.select("user_id", "ts_ms", *user_columns), ["user_id", "ts_ms"])
    elif user_columns:
        full = full.join(kept.select("__positive", *user_columns), "__positive")
    others = [c for c in metadata.columns if c != "item_id"]
    return shuffle_rows(
        full.select(*columns, *user_columns, *stat_columns, *others), seed, ["user_id", "item_id", "ts_ms", "rating"]
    )


def first_metadata(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Metadata of the first row per item, first by time."""
    return first_per_key(rows, ["item_id"], [F.asc("ts_ms"), F.asc("user_id")]).select("item_id", *columns)


def checked(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table, computed once and kept, after making sure that no key is null."""
    kept = durable(table)
    return require_clean_keys(kept, keys, unique=False) if keys else kept
