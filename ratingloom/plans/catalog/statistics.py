"""Aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.operators import selection, sets, stats
from ratingloom.operators.ordered import first_per_key
from ratingloom.operators.ranking import POPULAR_CANDIDATES, popular_items
from ratingloom.operators.skipgram import sequence_positions
from ratingloom.plans import feature_job
from ratingloom.plans.catalog.base import CUT_MS, joined, query, rounded
from ratingloom.plans.catalog.rows import SEQUENCES, enriched, labelled
from ratingloom.session import durable
from ratingloom.sources import views

FIRST_ITEM_ROWS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, event_ts ORDER BY rating DESC,
    user_id) AS rn FROM interactions) WHERE rn = 1"""


def train_val(spark, folder):
    rows = views.interactions(spark, folder)
    return rows.where(F.col("ts_ms") < CUT_MS), rows.where(F.col("ts_ms") >= CUT_MS)


@query(
    "a1_collapse_item_ts",
    """SELECT item_id, f.ts_ms, f.rating, main_category, price, array_to_string(list_distinct_kept, '|') AS categories
       FROM firsts f JOIN (SELECT *, list_filter(categories, lambda v, i: list_position(categories, v) = i) AS
       list_distinct_kept FROM items) USING (item_id)""",
    {"firsts": FIRST_ITEM_ROWS},
)
def a1_collapse_item_ts(spark, folder):
    collapsed = feature_job.collapse_item_ts(enriched(spark, folder))
    return collapsed.drop("event_ts").withColumn("categories", joined("categories", "|"))


@query(
    "a2_time_range",
    f"""SELECT CASE WHEN ts_ms < {CUT_MS} THEN 'train' ELSE 'val' END AS source, min(ts_ms) AS min_ts_ms,
        max(ts_ms) AS max_ts_ms FROM interactions GROUP BY 1
        UNION ALL SELECT 'all', min(ts_ms), max(ts_ms) FROM interactions""",
)
def a2_time_range(spark, folder):
    """Ranges per source, and the overall newest time from them."""
    parts = stats.time_range(labelled(spark, folder), by=["source"])
    both = F.explode(F.array(F.col("source"), F.lit("all")))
    return parts.withColumn("source", both).groupBy("source").agg(
        F.min("min_ts_ms").alias("min_ts_ms"), F.max("max_ts_ms").alias("max_ts_ms")
    )


@query(
    "a3_overlap_stats",
    """SELECT train_rows, train_users, train_items, val_users, val_items,
       round(known_users / val_users, 6) AS known_user_share, round(known_items / val_items, 6) AS known_item_share,
       round(1 - train_rows / (train_users * train_items), 6) AS sparsity FROM (
       SELECT (SELECT count(*) FROM train) AS train_rows, (SELECT count(DISTINCT user_id) FROM train) AS train_users,
       (SELECT count(DISTINCT item_id) FROM train) AS train_items, (SELECT count(DISTINCT user_id) FROM val) AS val_users,
       (SELECT count(DISTINCT item_id) FROM val) AS val_items,
       (SELECT count(DISTINCT user_id) FROM val WHERE user_id IN (SELECT user_id FROM train)) AS known_users,
       (SELECT count(DISTINCT item_id) FROM val WHERE item_id IN (SELECT item_id FROM train)) AS known_items)""",
)
def a3_overlap_stats(spark, folder):
    found = stats.overlap_stats(*train_val(spark, folder))
    return found.withColumns({c: rounded(c) for c in ("known_user_share", "known_item_share", "sparsity")})


POPULARITY_SQL = """SELECT item_id, count(rating) AS rating_count, avg(rating) AS rating_avg,
    count(rating) * (avg(rating) - 3.0) AS score FROM interactions GROUP BY item_id"""


@query("a4_popularity", POPULARITY_SQL)
def a4_popularity(spark, folder):
    return stats.popularity(views.item_ratings(spark, folder))


@query(
    "a5_item_popularity",
    "SELECT item_id, count(*) AS n_rows, round(count(*) / (SELECT count(*) FROM lineitem), 9) AS share FROM interactions GROUP BY item_id",
)
def a5_item_popularity(spark, folder):
    return stats.item_shares(views.item_ratings(spark, folder)).withColumn("share", rounded("share", 9))


@query("a6_user_item_sets", "SELECT DISTINCT user_id, item_id FROM interactions")
def a6_user_item_sets(spark, folder):
    return stats.user_items(views.interactions(spark, folder))


@query("a7_user_sequences", "SELECT user_id, CAST(pos AS INTEGER) AS pos, item_id FROM positions", SEQUENCES)
def a7_user_sequences(spark, folder):
    """Every user's items in order, as rows, so that no sequence is too long."""
    return sequence_positions(views.interactions(spark, folder))


LOCAL = {"local_times": "SELECT timezone('US/Eastern', timezone('UTC', ts)) AS t FROM events"}


@query(
    "a8_calendar_counts",
    """SELECT unit, CAST(slot AS INTEGER) AS slot, coalesce(n, 0) AS n_rows FROM (
         SELECT 'weekday' AS unit, unnest(range(1, 8)) AS slot UNION ALL SELECT 'hour', unnest(range(0, 24))
         UNION ALL SELECT 'month', unnest(range(1, 13))) LEFT JOIN (
         SELECT 'weekday' AS unit, isodow(t) AS slot, count(*) AS n FROM local_times GROUP BY 2
         UNION ALL SELECT 'hour', hour(t), count(*) FROM local_times GROUP BY 2
         UNION ALL SELECT 'month', month(t), count(*) FROM local_times GROUP BY 2) USING (unit, slot)""",
    LOCAL,
)
def a8_calendar_counts(spark, folder):
    return stats.calendar_counts(views.stream(spark, folder))


@query("a9_basket_freq", "SELECT item_id, count(DISTINCT user_id) AS n_sequences FROM positions GROUP BY item_id", SEQUENCES)
def a9_basket_freq(spark, folder):
    return stats.basket_frequency(sequence_positions(views.interactions(spark, folder)))



@query(
    "a10_first_per_key",
    """SELECT item_id, user_id, rating, ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY item_id
       ORDER BY ts_ms, user_id, rating) AS rn FROM interactions) WHERE rn = 1""",
)
def a10_first_per_key(spark, folder):
    rows = views.interactions(spark, folder).drop("event_ts")
    return first_per_key(rows, ["item_id"], [F.asc("ts_ms"), F.asc("user_id"), F.asc("rating")])


@query(
    "a11_profile",
    """SELECT 'rating' AS column_name, count(rating) AS n, count(DISTINCT rating) AS n_distinct, round(avg(rating), 6) AS mean,
       round(stddev_samp(rating), 6) AS std, min(rating) AS min, quantile_cont(rating, 0.25) AS q25,
       quantile_cont(rating, 0.5) AS q50, quantile_cont(rating, 0.75) AS q75, max(rating) AS max,
       (SELECT rating FROM interactions GROUP BY rating ORDER BY count(*) DESC, rating LIMIT 1) AS top FROM interactions
       UNION ALL SELECT 'size', count(p_size), count(DISTINCT p_size), round(avg(p_size), 6), round(stddev_samp(p_size), 6),
       min(p_size), quantile_cont(p_size, 0.25), quantile_cont(p_size, 0.5), quantile_cont(p_size, 0.75), max(p_size),
       (SELECT p_size FROM part GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1) FROM part""",
)
def a11_profile(spark, folder):
    ratings = views.item_ratings(spark, folder).select("rating")
    sizes = views.table(spark, folder, "part", "p_size").select(F.col("p_size").cast("double").alias("size"))
    parts = []
    for rows, column in ((ratings, "rating"), (sizes, "size")):
        top = stats.most_common(rows, column).select(column).scalar()
        parts.append(stats.profile(rows, [column]).withColumn("top", top))
    both = parts[0].unionByName(parts[1])
    return both.withColumns({"mean": rounded("mean"), "std": rounded("std")})


@query(
    "a11_quartiles",
    """SELECT 'l_extendedprice' AS column_name, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
       round(quantile_cont(l_extendedprice, 0.75), 6) AS q75 FROM lineitem UNION ALL
       SELECT 'l_orderkey', quantile_cont(CAST(l_orderkey AS DOUBLE), 0.25), quantile_cont(CAST(l_orderkey AS DOUBLE), 0.5), quantile_cont(CAST(l_orderkey AS DOUBLE), 0.75) FROM lineitem""",
)
def a11_quartiles(spark, folder):
    """Exact quartiles of columns with nearly as many values as rows."""
    columns = ["l_extendedprice", "l_orderkey"]
    found = selection.quantiles(views.table(spark, folder, "lineitem", *columns), columns, (0.25, 0.5, 0.75))
    rows = spark.createDataFrame([(c, *q) for c, q in found.items()], "column_name string, q25 double, q50 double, q75 double")
    return rows.withColumns({q: rounded(q) for q in ("q25", "q50", "q75")})


SCORED = {
    "scored": """SELECT i.user_id, i.item_id, i.ts_ms, CAST(i.rating > 3 AS INTEGER) AS label, p.rating_avg / 5 AS p
        FROM interactions i JOIN (SELECT item_id, avg(rating) AS rating_avg FROM interactions GROUP BY item_id) p
        USING (item_id)"""
}


def scored(spark, folder):
    """Interactions with a binary label and their item's mean rating as probability."""
    means = stats.popularity(views.item_ratings(spark, folder)).select("item_id", (F.col("rating_avg") / 5).alias("p"))
    return views.interactions(spark, folder).join(means, "item_id").withColumn("label", (F.col("rating") > 3).cast("int"))


@query(
    "a12_weighted_bce",
    """SELECT round(avg(CASE WHEN label = 1 THEN -2.5 * greatest(CASE WHEN p > 0 THEN ln(p) ELSE -100 END, -100)
       ELSE -greatest(CASE WHEN p < 1 THEN ln(1 - p) ELSE -100 END, -100) END), 6) AS loss, count(*) AS n_rows FROM scored""",
    SCORED,
)
def a12_weighted_bce(spark, folder):
    found = stats.weighted_bce(scored(spark, folder), "label", "p", 2.5)
    return found.withColumn("loss", rounded("loss"))


@query("u1_union_all", "SELECT user_id, item_id, ts_ms, 'train' AS source, NULL::DOUBLE AS rating FROM train UNION ALL SELECT user_id, item_id, ts_ms, 'val', rating FROM val")
def u1_union_all(spark, folder):
    train, val = train_val(spark, folder)
    return sets.stack(
        train.select("user_id", "item_id", "ts_ms").withColumn("source", F.lit("train")),
        val.select("user_id", "item_id", "ts_ms", "rating").withColumn("source", F.lit("val")),
    )


@query(
    "u2_difference",
    """SELECT 'left' AS side, user_id, item_id FROM (SELECT user_id, item_id FROM train EXCEPT SELECT user_id, item_id FROM val)
       UNION ALL SELECT 'right', user_id, item_id FROM (SELECT user_id, item_id FROM val EXCEPT SELECT user_id, item_id FROM train)""",
)
def u2_difference(spark, folder):
    train, val = train_val(spark, folder)
    return sets.differences(train, val, ["user_id", "item_id"])


@query("u3_intersection", "SELECT user_id FROM train INTERSECT SELECT user_id FROM val")
def u3_intersection(spark, folder):
    return sets.common(*train_val(spark, folder), ["user_id"])


@query(
    "u4_candidates_minus_seen",
    """SELECT c.user_id, c.item_id FROM (SELECT u.user_id, p.item_id FROM (SELECT DISTINCT user_id FROM interactions) u,
         (SELECT item_id FROM popularity ORDER BY score DESC, item_id LIMIT 20) p) c
       ANTI JOIN interactions USING (user_id, item_id)""",
    {"popularity": POPULARITY_SQL},
)
def u4_candidates_minus_seen(spark, folder):
    rows = views.interactions(spark, folder)
    popular = popular_items(stats.popularity(views.item_ratings(spark, folder)), POPULAR_CANDIDATES)
    ids = [r["item_id"] for r in popular.collect()]  # twenty at most
    users = rows.select("user_id").distinct()
    offered = users.select("user_id", F.explode(F.array(*[F.lit(i).cast("long") for i in ids])).alias("item_id"))
    return sets.without(offered, rows, ["user_id", "item_id"])
