"""Window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions import times
from ratingloom.operators.dictionary import build_dictionary, ids_of, map_ids
from ratingloom.operators.ordered import numbered
from ratingloom.operators.skew import find_cuts
from ratingloom.plans import feature_job
from ratingloom.plans.catalog.base import CUT_MS, joined, query
from ratingloom.plans.catalog.rows import BUCKET_CASE
from ratingloom.plans.catalog.statistics import FIRST_ITEM_ROWS
from ratingloom.sources import views

FIRSTS = {"firsts": FIRST_ITEM_ROWS}


def _frames(key: str, prefix: str, days) -> str:
    return ", ".join(
        f"count(*) OVER (PARTITION BY {key} ORDER BY ts_ms RANGE BETWEEN {n * times.DAY_MS} PRECEDING AND 1 PRECEDING)"
        f" AS {prefix}_cnt_{n}d, avg(rating) OVER (PARTITION BY {key} ORDER BY ts_ms RANGE BETWEEN {n * times.DAY_MS}"
        f" PRECEDING AND 1 PRECEDING) AS {prefix}_avg_{n}d"
        for n in days
    )


ITEM_STATS = {**FIRSTS, "item_stats": f"SELECT item_id, ts_ms, rating, {_frames('item_id', 'item_rating', feature_job.ITEM_DAYS)} FROM firsts"}
# Some ratings are made null by a rule, so that rows and rows with a value differ.
GAP = "CASE WHEN (ts_ms // 1000) % 7 <> 0 THEN rating END"
GAPPY = {
    **FIRSTS,
    "gappy": f"SELECT * REPLACE ({GAP} AS rating) FROM firsts",
    "gappy_stats": f"SELECT item_id, ts_ms, rating, {_frames('item_id', 'item_rating', feature_job.ITEM_DAYS)} FROM gappy",
    "gappy_rows": f"SELECT * REPLACE ({GAP} AS rating) FROM interactions",
}


def with_gaps(rows):
    return rows.withColumn("rating", F.when((F.col("ts_ms") / 1000).cast("long") % 7 != 0, F.col("rating")))


USER_STATS_SQL = f"SELECT user_id, item_id, ts_ms, {_frames('user_id', 'user_rating', (90,))} FROM interactions"

# Distinct (user, item, time) rows; a full copy would only repeat its own row.
HISTORY = {
    "sequence_rows": "SELECT DISTINCT user_id, item_id, event_ts, ts_ms FROM interactions",
    "history": """SELECT *, list(item_id) OVER w AS hist_items, list(event_ts) OVER w AS hist_times,
        row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_ts, item_id) AS pos FROM sequence_rows
        WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, event_ts, item_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""",
    "longest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_ts
        ORDER BY coalesce(len(hist_items), 0) DESC, pos DESC) AS rn FROM history) WHERE rn = 1""",
    "padded": """SELECT *, list_concat(list_transform(range(10 - coalesce(len(hist_times), 0)), lambda i: CAST(-1 AS BIGINT)),
        list_transform(coalesce(hist_times, []), lambda t: epoch_us(t) // 1000000)) AS seconds FROM history""",
}
ITEMS_TEXT = "coalesce(array_to_string(hist_items, ','), '')"
TIMES_TEXT = "coalesce(array_to_string(list_transform(hist_times, lambda t: strftime(t, '%Y-%m-%dT%H:%M:%S.%gZ')), ','), '')"


def sequence_rows(spark, folder):
    return views.interactions(spark, folder).select("user_id", "item_id", "event_ts", "ts_ms").distinct()


@query("w1_latest_per_item_ts", "SELECT item_id, ts_ms, rating, user_id FROM firsts", FIRSTS)
def w1_latest_per_item_ts(spark, folder):
    return feature_job.latest_per_item_ts(views.interactions(spark, folder)).drop("event_ts")


def item_stats(spark, folder):
    rows = views.item_ratings(spark, folder)
    points = feature_job.item_points(rows).drop("event_ts")
    return feature_job.item_features(points, find_cuts(rows, "item_id", "ts_ms"))


@query("w2_item_trailing_stats", "SELECT * FROM gappy_stats", GAPPY)
def w2_item_trailing_stats(spark, folder):
    rows = views.item_ratings(spark, folder)
    points = with_gaps(feature_job.item_points(rows).drop("event_ts"))
    return feature_job.item_features(points, find_cuts(rows, "item_id", "ts_ms"))


@query("w3_user_trailing_stats", USER_STATS_SQL.replace("FROM interactions", "FROM gappy_rows"), GAPPY)
def w3_user_trailing_stats(spark, folder):
    rows = with_gaps(views.interactions(spark, folder).drop("event_ts"))
    return feature_job.user_stats(rows, find_cuts(rows, "user_id", "ts_ms")).drop("rating")


def user_stats(spark, folder):
    rows = views.interactions(spark, folder).drop("event_ts")
    return feature_job.user_stats(rows, find_cuts(rows, "user_id", "ts_ms")).drop("rating")


@query("w4_user_recent_items", f"SELECT user_id, item_id, ts_ms, {ITEMS_TEXT} AS recent_items, {TIMES_TEXT} AS recent_times FROM history", HISTORY)
def w4_user_recent_items(spark, folder):
    rows = sequence_rows(spark, folder)
    history = feature_job.user_history(rows, find_cuts(rows, "user_id", "ts_ms"))
    return history.select(
        "user_id", "item_id", "ts_ms",
        joined("hist.item_id").alias("recent_items"),
        joined(F.transform("hist.event_ts", lambda t: times.iso_text(t))).alias("recent_times"),
    )


@query(
    "w5_sequence_ts_buckets",
    f"""SELECT user_id, item_id, ts_ms, array_to_string(seconds, ',') AS item_sequence_ts,
        array_to_string(list_transform(seconds, lambda s: CASE WHEN s = -1 THEN -1 ELSE
        {BUCKET_CASE.format(s='(ts_ms // 1000 - s)')} END), ',') AS item_sequence_ts_bucket FROM padded""",
    HISTORY,
)
def w5_sequence_ts_buckets(spark, folder):
    rows = sequence_rows(spark, folder)
    full = feature_job.sequence_columns(feature_job.user_history(rows, find_cuts(rows, "user_id", "ts_ms")))
    return full.select(
        "user_id", "item_id", "ts_ms",
        joined("item_sequence_ts").alias("item_sequence_ts"),
        joined("item_sequence_ts_bucket").alias("item_sequence_ts_bucket"),
    )


@query(
    "w6_user_dedup",
    f"SELECT user_id, item_id, ts_ms, coalesce(len(hist_items), 0) AS n_recent, {ITEMS_TEXT} AS recent_items FROM longest",
    HISTORY,
)
def w6_user_dedup(spark, folder):
    rows = sequence_rows(spark, folder)
    history = feature_job.user_history(rows, find_cuts(rows, "user_id", "ts_ms"), mark_last=True)
    return feature_job.longest_per_user_ts(history).select(
        "user_id", "item_id", "ts_ms",
        F.size("hist").cast("long").alias("n_recent"),
        joined("hist.item_id").alias("recent_items"),
    )


LABELS_SQL = f"""SELECT user_id, item_id, rating, ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
    ORDER BY ts_ms DESC, rating DESC) AS rn FROM val) WHERE rn = 1"""


def labels(spark, folder):
    """Validation ratings, the newest per (user, item), found by an aggregate."""
    rows = views.interactions(spark, folder).where(F.col("ts_ms") >= CUT_MS)
    newest = F.max(F.struct("ts_ms", "rating")).alias("n")
    return rows.groupBy("user_id", "item_id").agg(newest).select("user_id", "item_id", "n.rating", "n.ts_ms")


@query(
    "w7_label_rank",
    """SELECT user_id, item_id, rating, ts_ms, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, ts_ms DESC,
       item_id)::INTEGER AS rating_rank FROM labels_val""",
    {"labels_val": LABELS_SQL},
)
def w7_label_rank(spark, folder):
    rows = labels(spark, folder)
    order = [F.desc("rating"), F.desc("ts_ms"), F.asc("item_id")]
    return numbered(
        rows, "user_id", order, "rating_rank", find_cuts(rows, "user_id", "ts_ms"), leading=["rating"], descending=True
    )


@query(
    "w8_rec_rank",
    """SELECT user_indice, CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, row_number() OVER (
       PARTITION BY user_id ORDER BY n DESC, item_id)::INTEGER AS rec_rank FROM (SELECT user_id, item_id, count(*) AS n
       FROM interactions GROUP BY ALL) JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_indice FROM
       (SELECT DISTINCT user_id FROM interactions)) USING (user_id)""",
)
def w8_rec_rank(spark, folder):
    """Items of a user ranked by their count, in index space, then mapped back to ids."""
    rows = views.interactions(spark, folder)
    users, items = build_dictionary(rows, "user_id"), build_dictionary(rows, "item_id")
    counted = rows.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("score"))
    indexed = map_ids(map_ids(counted, users, "user_id", "user_indice", -1), items, "item_id", "item_indice", -1)
    recs = indexed.select("user_indice", "item_indice", "score")
    cuts = find_cuts(recs, "user_indice", "item_indice")
    ranked = numbered(
        recs, "user_indice", [F.desc("score"), F.asc("item_indice")], "rec_rank", cuts, leading=["score"]
    )
    named = ids_of(ids_of(ranked, users, "user_indice", "user_id"), items, "item_indice", "item_id")
    return named.select("user_indice", "user_id", "item_id", "rec_rank")
