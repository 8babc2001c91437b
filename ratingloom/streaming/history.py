"""User histories kept current from a change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratingloom.functions.times import HISTORY_LENGTH, bucket_sequence, iso_seconds, keep_last, padded_seconds_from_text
from ratingloom.operators.ordered import top_per_key
from ratingloom.session import durable
from ratingloom.sources.changes import decode_changes
from ratingloom.sources.keyed_state import CAPACITY, KeyedState

# Fixed value: liked items count as this much later than the newest one in the history.
LIKE_DELAY_MS = 2 * 86_400_000

SNAPSHOT_KEYS = ["user_id"]
CLEAN_EVERY = 16  # micro-batches


def change_events(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Readable changes as user_id, item_id, time text and its epoch ms (-1 when the time is unreadable)."""
    good, _ = decode_changes(df, payload)
    return good.select(
        "user_id",
        "item_id",
        F.col("timestamp").alias("time"),
        F.coalesce(_millis(F.col("timestamp")), F.lit(-1).cast("long")).alias("ms"),
    )


def _millis(text):
    digits = F.rpad(F.regexp_extract(text, r"\.(\d{1,3})\d*Z$", 1), 3, "0")
    fraction = F.coalesce(digits.try_cast("int"), F.lit(0))
    return iso_seconds(text) * 1000 + fraction


def newest_events(batch: DataFrame) -> DataFrame:
    """(user_id, new, seen): the newest ten events of each user in a micro-batch, oldest first, and how many there were.

    The row number is limited before the shuffle, so a hot user sends ten rows per task.
    """
    order = [F.desc("ms"), F.desc("item_id"), F.desc("time")]
    newest = top_per_key(batch, ["user_id"], order, HISTORY_LENGTH).groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("ms", "item_id", "time"))).alias("new")
    )
    seen = batch.groupBy("user_id").agg(F.count(F.lit(1)).alias("seen"))
    return newest.join(seen, "user_id")


def advance(events: DataFrame, known: DataFrame | None) -> DataFrame:
    """One row per touched user: the last ten of what is known and what is new, in that order."""

    def parts(column: str):
        text = F.coalesce(F.col(column), F.lit(""))
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))

    new = newest_events(events)
    columns = ("recent_items", "recent_times", "n_events")
    if known is None:
        rows = new.select("*", *[F.lit(None).cast("long" if c == "n_events" else "string").alias(c) for c in columns])
    else:
        rows = new.join(known.select("user_id", *columns), "user_id", "left")
    items = keep_last(F.concat(parts("recent_items"), F.col("new.item_id")), HISTORY_LENGTH)
    times = keep_last(F.concat(parts("recent_times"), F.col("new.time")), HISTORY_LENGTH)
    return rows.select(
        "user_id",
        F.array_join(items, ",").alias("recent_items"),
        F.array_join(times, ",").alias("recent_times"),
        F.element_at("new.ms", -1).alias("last_event_ms"),
        (F.coalesce("n_events", F.lit(0)) + F.col("seen")).alias("n_events"),
    )


def with_sequences(updates: DataFrame) -> DataFrame:
    """Add the ten epoch seconds and the age buckets relative to the newest entry."""
    seconds = padded_seconds_from_text(F.col("recent_times"))
    now = F.element_at("item_sequence_ts", -1)
    return updates.withColumn("item_sequence_ts", seconds).withColumn(
        "item_sequence_ts_bucket", bucket_sequence(F.col("item_sequence_ts"), F.when(now != -1, now * 1000))
    )


def history_state(spark: SparkSession, path: str, capacity: int = CAPACITY) -> KeyedState:
    return KeyedState(spark, path, SNAPSHOT_KEYS, capacity)


def start_history(
    changes: DataFrame, snapshot: str, checkpoint: str, payload: str = "payload", capacity: int = CAPACITY
) -> StreamingQuery:
    """Run over all changes available now; every micro-batch updates the rows of its users in the keyed state.

    A batch reads the buckets of its own users as batches before it have left them, so one that is run again gives
    the same rows. Its records are decoded once and kept; the steps of an update read what was decoded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        state = history_state(batch.sparkSession, snapshot, capacity)
        state.update(durable(batch), batch_id, lambda events, known: with_sequences(advance(events, known)))
        if batch_id % CLEAN_EVERY == CLEAN_EVERY - 1:
            state.clean()

    return (
        change_events(changes, payload)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def current_users(spark: SparkSession, snapshot: str) -> DataFrame | None:
    """Row of every user in the state."""
    return history_state(spark, snapshot).current()


def start_quarantine(changes: DataFrame, good_path: str, bad_path: str, checkpoint: str, payload: str = "payload") -> StreamingQuery:
    """Decode a stream; readable and unreadable records go to separate folders, one sub-folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = decode_changes(batch, payload)
        good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")

    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def append_likes(history: DataFrame, likes: DataFrame, n: int = HISTORY_LENGTH) -> DataFrame:
    """Append liked items to histories, all at two days after the newest entry, and keep the last n.

    `history`: user_id, items, seconds (bounded arrays, oldest first); `likes`: user_id, item_id, position.
    Only the last n likes of a user can stay, so only those are collected.
    """
    last = top_per_key(likes, ["user_id"], [F.desc("position"), F.desc("item_id")], n)
    liked = last.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "item_id"))).alias("__l")
    ).select("user_id", F.col("__l.item_id").alias("__liked"))
    at = F.array_max("seconds") + LIKE_DELAY_MS // 1000
    joined = history.join(liked, "user_id")
    items = F.concat("items", "__liked")
    seconds = F.concat("seconds", F.transform("__liked", lambda _: at))
    tail = F.greatest(F.size(items) - n, F.lit(0)) + 1
    return joined.select(
        "user_id", F.slice(items, tail, F.lit(n)).alias("items"), F.slice(seconds, tail, F.lit(n)).alias("seconds")
    )
