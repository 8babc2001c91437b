"""The batch feature job: item and user feature tables as of every rating."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.text import parse_categories
from ratingloom.functions.times import HISTORY_LENGTH, bucket_sequence, iso_text, padded_seconds
from ratingloom.operators import quality
from ratingloom.operators.clean import drop_exact_duplicates, split_by_source
from ratingloom.operators.joins import require_coverage
from ratingloom.operators.ordered import first_per_key, previous_rows
from ratingloom.operators.skew import KeyCuts, find_cuts
from ratingloom.operators.trailing import trailing_stats
from ratingloom.session import durable
from ratingloom.sources.files import write_table

# Trailing windows in days.
ITEM_DAYS = (365, 90, 30, 7)
USER_DAYS = (90,)
ITEM_NAMES = {n: (f"item_rating_cnt_{n}d", f"item_rating_avg_{n}d") for n in ITEM_DAYS}
USER_NAMES = {90: ("user_rating_cnt_90d", "user_rating_avg_90d")}
ITEM_STAT_COLUMNS = [c for n in ITEM_DAYS for c in ITEM_NAMES[n]]
DEDUP_COLUMNS = ("user_id", "item_id", "event_ts", "rating", "main_category", "categories", "price")


def latest_per_item_ts(rows: DataFrame) -> DataFrame:
    """One row per (item, time): highest rating, then lowest user id."""
    return first_per_key(rows, ["item_id", "event_ts"], [F.desc("rating"), F.asc("user_id")])


def collapse_item_ts(rows: DataFrame) -> DataFrame:
    """Per (item, time) the category, price, rating and distinct category names of its first row.

    The first row is the one `latest_per_item_ts` keeps, found here by an aggregate with map-side combine.
    `rows` carry item metadata; `categories` may be text in either list layout or an array.
    """
    first = F.struct("main_category", F.col("price").cast("string").alias("price"), "rating", "categories")
    best = F.min_by(first, F.struct(-F.col("rating"), F.col("user_id")))
    is_text = dict(rows.dtypes)["categories"] == "string"
    names = parse_categories(F.col("categories")) if is_text else F.col("categories")
    return (
        rows.groupBy("item_id", "event_ts", "ts_ms")
        .agg(best.alias("__f"))
        .select("item_id", "event_ts", "ts_ms", "__f.*")
        .withColumn("categories", F.array_distinct(names))
    )


def item_points(rows: DataFrame) -> DataFrame:
    """(item, time) with the rating of its first row, without metadata; an aggregate with map-side combine."""
    best = F.min_by("rating", F.struct(-F.col("rating")))
    return rows.groupBy("item_id", "event_ts", "ts_ms").agg(best.alias("rating"))


def item_features(points: DataFrame, cuts: KeyCuts | None = None) -> DataFrame:
    """Trailing counts and means per (item, time) row."""
    return trailing_stats(points, "item_id", "ts_ms", "rating", ITEM_DAYS, ITEM_NAMES, cuts)


def user_stats(rows: DataFrame, cuts: KeyCuts | None = None) -> DataFrame:
    return trailing_stats(rows, "user_id", "ts_ms", "rating", USER_DAYS, USER_NAMES, cuts)


def _user_order() -> list[Column]:
    return [F.col("ts_ms"), F.col("event_ts"), F.col("item_id")]


def user_history(
    rows: DataFrame, cuts: KeyCuts | None = None, mark_last: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Add `hist`, the up to ten earlier (item_id, event_ts, carried columns) of the user, oldest first.

    With `mark_last` also `__next_ts`, the time of the user's next row, from the same sorted pass.
    """
    extra = {"__next_ts": lambda w: F.lead("event_ts").over(w)} if mark_last else None
    payload = F.struct("item_id", "event_ts", *carry)
    return previous_rows(rows, "user_id", _user_order(), payload, HISTORY_LENGTH, "hist", cuts, extra)


def longest_per_user_ts(history: DataFrame) -> DataFrame:
    """Per (user, time) the row with the longest history, which is the last one in sequence order.

    Needs `__next_ts`: rows of one time lie side by side, so no further shuffle is needed.
    """
    last = F.col("__next_ts").isNull() | (F.col("__next_ts") != F.col("event_ts"))
    return history.where(last).drop("__next_ts")


def sequence_columns(df: DataFrame) -> DataFrame:
    """Replace `hist` by item list, ISO time list, ten epoch seconds and ten age buckets."""
    return df.withColumns({
        "recent_items": F.col("hist.item_id"),
        "recent_times": F.transform("hist.event_ts", lambda t: iso_text(t)),
        "item_sequence_ts": padded_seconds(F.col("hist.event_ts")),
    }).withColumn("item_sequence_ts_bucket", bucket_sequence(F.col("item_sequence_ts"), F.col("ts_ms"))).drop("hist")


def user_features(rows: DataFrame, cuts: KeyCuts | None = None) -> DataFrame:
    """One row per (user, time): trailing statistics and recent history. Both windows share one shuffle.

    Statistics count every row; a history holds each (item, time) of the user once, with its highest rating.
    """
    stats = user_stats(rows, cuts)
    keys = [c for c in stats.columns if c != "rating"]
    visits = stats.groupBy(*keys).agg(F.max("rating").alias("rating")).select(*stats.columns)
    longest = longest_per_user_ts(user_history(visits, cuts, mark_last=True))
    return sequence_columns(longest)


def current_history(rows: DataFrame, n: int = HISTORY_LENGTH) -> DataFrame:
    """Per user the newest n rows as `hist` (oldest first) and the newest item. A hot user sends n rows per task."""
    newest = Window.partitionBy("user_id").orderBy(F.desc("ts_ms"), F.desc("event_ts"), F.desc("item_id"))
    kept = rows.withColumn("__back", F.row_number().over(newest)).where(F.col("__back") <= n)
    return (
        kept.groupBy("user_id")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("__back")).alias("p"), "item_id", "event_ts"))).alias("h"))
        .select(
            "user_id",
            F.transform("h", lambda x: F.struct(x["item_id"].alias("item_id"), x["event_ts"].alias("event_ts"))).alias("hist"),
            F.element_at("h.item_id", -1).alias("last_item"),
        )
    )


def run_feature_job(ratings: DataFrame, folder: str) -> dict[str, str]:
    """Deduplicate, split, check coverage, compute both feature tables, gate them, write everything.

    `ratings` carry user_id, item_id, rating, event_ts, ts_ms, main_category, categories, price and source.
    Nothing is written unless both tables pass their rules. Returns the paths by name.
    """
    rows = durable(drop_exact_duplicates(ratings, DEDUP_COLUMNS))
    train, val = split_by_source(rows)
    require_coverage(val, train, ["item_id", "user_id"])
    tables = {
        "item_stats": durable(item_features(collapse_item_ts(rows), find_cuts(rows, "item_id", "ts_ms"))),
        "user_stats": durable(user_features(
            rows.select("user_id", "item_id", "rating", "event_ts", "ts_ms"), find_cuts(rows, "user_id", "ts_ms")
        )),
    }
    quality.enforce(tables["item_stats"], quality.ITEM_RULES)
    quality.enforce(tables["user_stats"], quality.USER_RULES)
    tables |= {"train": train, "val": val}
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in tables}
