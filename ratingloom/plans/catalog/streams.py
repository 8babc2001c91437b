"""Streaming jobs, run over everything the files hold and read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.operators.clean import conform, holdout_cutoff
from ratingloom.plans import feature_job
from ratingloom.plans.catalog.base import CUT_MS, joined, query, rounded, scratch
from ratingloom.plans.catalog.rows import BUCKET_CASE, CHANGE_SQL, LATEST_SQL, LOOSE, change_records, loose_rows
from ratingloom.sources import views
from ratingloom.sources.changes import CHANGE_SCHEMA
from ratingloom.sources.snapshot import read_snapshot, upsert_latest
from ratingloom.streaming import drift, history, replay


# Change records of a file: a file is one task, and decoding a record takes some ten microseconds.
RECORDS_PER_FILE = 100_000


def record_stream(spark, folder, slices: int = 4):
    """The events as a stream of change records, in time order, one slice per micro-batch."""
    path = scratch(spark, "records")
    records = change_records(spark, folder)
    files = replay.write_replay(records, path, slices=slices, rows_per_file=RECORDS_PER_FILE)
    return replay.replay(spark, path, records.schema, files)


@query(
    "replay_holdout",
    """SELECT user_id, item_id, rating, ts_ms FROM interactions WHERE event_ts >= (SELECT date_trunc('day', max(event_ts))
       - INTERVAL 30 DAY FROM interactions)""",
)
def replay_holdout(spark, folder):
    """Hold-out rows written in time order, streamed in small batches into a table."""
    rows = views.interactions(spark, folder)
    held = rows.where(F.col("ts_ms") >= holdout_cutoff(views.item_ratings(spark, folder))).drop("event_ts")
    source, target = scratch(spark, "holdout"), scratch(spark, "arrived")
    files = replay.write_replay(held, source)
    query_ = (
        replay.replay(spark, source, held.schema, files)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", scratch(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return spark.read.schema(held.schema).parquet(target).select("user_id", "item_id", "rating", "ts_ms")


@query("r1_decode", CHANGE_SQL)
def r1_decode(spark, folder):
    good, bad = scratch(spark, "good"), scratch(spark, "bad")
    stream = record_stream(spark, folder).drop("ts_ms")
    history.start_quarantine(stream, good, bad, scratch(spark, "checkpoint")).awaitTermination()
    fields = CHANGE_SCHEMA.removeprefix("data struct<").removesuffix(">")
    arrived = spark.read.schema("event_id long, " + fields.replace(":", " ")).parquet(f"{good}/batch=*")
    kept_aside = spark.read.schema("event_id long").parquet(f"{bad}/batch=*")
    return arrived.withColumn("readable", F.lit(True)).unionByName(
        kept_aside.withColumn("readable", F.lit(False)), allowMissingColumns=True
    )


@query(
    "r2_user_history",
    f"""SELECT user_id, n_events, recent_items, recent_times, array_to_string(s, ',') AS item_sequence_ts, array_to_string(
        list_transform(s, lambda x: CASE WHEN x = -1 THEN -1 ELSE {BUCKET_CASE.format(s='(s[10] - x)')} END), ',')
        AS item_sequence_ts_bucket FROM (SELECT user_id, n_events, array_to_string(items, ',') AS recent_items,
        array_to_string(list_transform(ts, lambda t: strftime(t, '%Y-%m-%dT%H:%M:%S.%gZ')), ',') AS recent_times,
        list_concat(list_transform(range(10 - len(ts)), lambda i: CAST(-1 AS BIGINT)), list_transform(ts, lambda t: epoch_us(t) // 1000000))
        AS s FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, max(n) AS n_events, list(item_id ORDER BY event_ts) AS items,
        list(event_ts ORDER BY event_ts) AS ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC) AS back,
        count(*) OVER (PARTITION BY user_id) AS n FROM stream WHERE event_type <> 'error') WHERE back <= 10 GROUP BY user_id))""",
)
def r2_user_history(spark, folder):
    path = scratch(spark, "users")
    history.start_history(record_stream(spark, folder), path, scratch(spark, "checkpoint")).awaitTermination()
    return history.current_users(spark, path).select(
        "user_id", "n_events", "recent_items", "recent_times",
        joined("item_sequence_ts").alias("item_sequence_ts"),
        joined("item_sequence_ts_bucket").alias("item_sequence_ts_bucket"),
    )


# The ratings arrive in three parts; the first two are enough for a report.
PARTS_MS = (788_918_400_000, CUT_MS)  # 1995-01-01


@query(
    "r3_drift_stream",
    f"""SELECT column_name, test, round(drift_score, 6) AS drift_score, drift_score >= 0.1 AS detected,
       (SELECT count(*) FROM arrived) AS n_rows, 1 AS batch FROM (
       SELECT column_name, 'ks' AS test, max(abs(r - c)) AS drift_score FROM (SELECT column_name,
         sum(sum(1)) OVER w / (SELECT count(*) FROM conformed) AS r,
         sum(sum(CASE WHEN ts_ms < {PARTS_MS[1]} THEN 1 ELSE 0 END)) OVER w / (SELECT count(*) FROM arrived) AS c
         FROM numbers GROUP BY column_name, value WINDOW w AS (PARTITION BY column_name ORDER BY value)) GROUP BY column_name
       UNION ALL SELECT column_name, 'js', sqrt(greatest(round(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 12), 0)) FROM (SELECT column_name, value,
         count(*) / (SELECT count(*) FROM conformed) AS p,
         count(*) FILTER (ts_ms < {PARTS_MS[1]}) / (SELECT count(*) FROM arrived) AS q
         FROM words GROUP BY column_name, value) GROUP BY column_name)""",
    {
        **LOOSE,
        "arrived": f"SELECT * FROM conformed WHERE ts_ms < {PARTS_MS[1]}",
        "numbers": """SELECT 'rating' AS column_name, rating AS value, ts_ms FROM conformed UNION ALL SELECT 'event_ts', ts_ms / 1000, ts_ms
            FROM conformed UNION ALL SELECT 'price', price, ts_ms FROM conformed""",
        "words": """SELECT 'user_id' AS column_name, user_id AS value, ts_ms FROM conformed UNION ALL SELECT 'item_id', item_id, ts_ms
            FROM conformed UNION ALL SELECT 'main_category', main_category, ts_ms FROM conformed""",
    },
)
def r3_drift_stream(spark, folder):
    """Ratings in time order against all ratings: a report once those of the first two parts have come in."""
    rows = loose_rows(spark, folder)
    source, reports = scratch(spark, "ratings"), scratch(spark, "reports")
    files = replay.write_replay(rows, source, cuts=list(PARTS_MS))
    reference = spark.read.schema(rows.schema).parquet(source)
    enough = conform(reference.where(F.col("ts_ms") < PARTS_MS[1])).count()
    drift.start_drift_watch(
        replay.replay(spark, source, rows.schema, files), reference, scratch(spark, "staging"), reports,
        scratch(spark, "checkpoint"), enough,
    ).awaitTermination()
    found = spark.read.option("basePath", reports).parquet(f"{reports}/closed=*").withColumnRenamed("closed", "batch")
    return found.withColumn("drift_score", rounded("drift_score"))


@query("r4_latest_upsert", LATEST_SQL)
def r4_latest_upsert(spark, folder):
    rows = views.stream(spark, folder).select("user_id", "item_id", "event_id", "ts_ms")
    source, target = scratch(spark, "rows"), scratch(spark, "latest")
    files = replay.write_replay(rows, source)
    keys, order = ["user_id"], ["ts_ms", "event_id"]
    query_ = (
        replay.replay(spark, source, rows.schema, files_per_trigger=2 * files)
        .writeStream.foreachBatch(lambda batch, number: upsert_latest(batch, number, target, keys, order, compact_every=2))
        .option("checkpointLocation", scratch(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return read_snapshot(spark, target, keys, order)


@query(
    "r5_multi_append",
    """SELECT user_id, array_to_string(list_slice(items, greatest(len(items) - 9, 1), len(items)), ',') AS items,
       array_to_string(list_slice(seconds, greatest(len(seconds) - 9, 1), len(seconds)), ',') AS seconds FROM (
       SELECT user_id, list_concat(h.items, l.items) AS items, list_concat(h.seconds, list_transform(l.items,
         lambda i: list_max(h.seconds) + 172800)) AS seconds FROM (
         SELECT user_id, list(item_id ORDER BY event_ts) AS items, list(ts_ms // 1000 ORDER BY event_ts) AS seconds FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, item_id DESC) AS back FROM stream
           WHERE event_type <> 'purchase') WHERE back <= 10 GROUP BY user_id) h JOIN (
         SELECT user_id, list(item_id ORDER BY event_id) AS items FROM stream WHERE event_type = 'purchase' GROUP BY user_id) l
         USING (user_id))""",
)
def r5_multi_append(spark, folder):
    """Purchases count as likes on top of the history of all other events."""
    rows = views.stream(spark, folder)
    current = feature_job.current_history(rows.where(F.col("event_type") != "purchase"))
    base = current.select(
        "user_id", F.col("hist.item_id").alias("items"),
        F.transform("hist.event_ts", lambda t: F.unix_seconds(t)).alias("seconds"),
    )
    likes = rows.where(F.col("event_type") == "purchase").select("user_id", "item_id", F.col("event_id").alias("position"))
    full = history.append_likes(base, likes)
    return full.select("user_id", joined("items").alias("items"), joined("seconds").alias("seconds"))
