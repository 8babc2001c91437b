"""Ranked lists: popular items, recent purchases, candidates per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.text import parse_price
from ratingloom.functions.vectors import norm, sigmoid
from ratingloom.operators.ordered import top_per_key
from ratingloom.operators.similarity import SCORE_DIGITS

# List lengths of the recommender.
POPULAR_KEPT = 500
POPULAR_CANDIDATES = 20
SIMILAR_CANDIDATES = 100
SIMILAR_KEPT = 10
MAX_CANDIDATES = 100
RECOMMENDED = 10
RECENT_SHOWN = 5

# What is shown for an absent part of an item, and for an unknown item.
NO_IMAGE = "https://via.placeholder.com/300x300?text=No+Image"
NO_TITLE, UNKNOWN, NO_DETAIL = "No title", "Unknown", "?"


def popular_items(scores: DataFrame, k: int = POPULAR_KEPT) -> DataFrame:
    """Top k by popularity score with rank. The window runs over the k rows the limit leaves."""
    best = scores.orderBy(F.desc("score"), "item_id").limit(k)
    ranked = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "item_id"))).alias("l"))
    return ranked.select(F.posexplode("l").alias("p", "e")).select(
        F.col("e.item_id").alias("item_id"), (-F.col("e.s")).alias("score"), (F.col("p") + 1).alias("rank")
    )


def best_by_score(scored: DataFrame, key: str, k: int, otherwise: str | None = None) -> DataFrame:
    """First k rows per key by score, compared after rounding, then by the lower item id. Rows without a score come
    last, in the order of the column `otherwise`."""
    order = [F.round("score", SCORE_DIGITS).desc_nulls_last()]
    if otherwise:
        order.append(F.when(F.col("score").isNull(), F.col(otherwise)))
    return top_per_key(scored, [key], [*order, F.asc("item_id")], k, rank="rank")


def similar_items(pairs: DataFrame, vectors: DataFrame, keep: int = SIMILAR_KEPT) -> DataFrame:
    """Rescore nearest neighbours by sigmoid(dot) of the raw vectors and keep the best.

    `pairs` holds the neighbours by cosine (query_id, item_id, raw_score), `vectors` (id, vector). The dot
    product is the cosine times both lengths, so only lengths are joined, not vectors.
    """
    lengths = vectors.select("id", norm(F.col("vector")).alias("__n"))
    a = lengths.select(F.col("id").alias("query_id"), F.col("__n").alias("__a"))
    b = lengths.select(F.col("id").alias("item_id"), F.col("__n").alias("__b"))
    scored = (
        pairs.select("query_id", "item_id", "raw_score")
        .join(a, "query_id")
        .join(b, "item_id")
        .select("query_id", "item_id", sigmoid(F.col("raw_score") * F.col("__a") * F.col("__b")).alias("score"))
    )
    return best_by_score(scored, "query_id", keep)


def recommendation_lists(ranked: DataFrame) -> DataFrame:
    """Ranked pairs -> one record per target item: target_item, rec_item_ids, rec_scores."""
    entry = F.struct("rank", "item_id", "score")
    return ranked.groupBy(F.col("query_id").alias("target_item")).agg(
        F.array_sort(F.collect_list(entry)).alias("recs")
    ).select(
        "target_item",
        F.col("recs.item_id").alias("rec_item_ids"),
        F.col("recs.score").alias("rec_scores"),
    )


def item_details(metadata: DataFrame, no_image: str = NO_IMAGE) -> DataFrame:
    """Shown title, image, categories, rating, reviews, price and store of an item, with the fallbacks for absent parts.

    Rating and reviews come from average_rating and rating_number; a column that the metadata lacks is absent for all.
    """
    present = set(metadata.columns)

    def part(name: str, kind: str, otherwise) -> Column:
        return F.coalesce(F.col(name).cast(kind), F.lit(otherwise)) if name in present else F.lit(otherwise)

    image = F.lit(None).cast("string")
    if "images" in present:
        image = F.coalesce(F.get("images.large", F.lit(0)), F.get("images.hi_res", F.lit(0)))
    main = F.coalesce(F.col("main_category"), F.lit("Unknown"))
    named = F.filter("categories", lambda c: c.isNotNull() & (c != ""))
    return metadata.select(
        "item_id",
        F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
        F.coalesce(image, F.lit(no_image)).alias("image_url"),
        F.when(F.size("categories") > 0, named).otherwise(F.array(main)).alias("categories"),
        part("average_rating", "double", 0.0).alias("rating"),
        part("rating_number", "long", 0).cast("long").alias("reviews"),
        part("price", "string", NO_DETAIL).alias("price"),
        part("store", "string", NO_DETAIL).alias("store"),
    )


def recent_purchases(history: DataFrame, metadata: DataFrame, shown: int = RECENT_SHOWN) -> DataFrame:
    """Newest entries of every user's history with item details; unknown items keep placeholder details.

    `history` holds user_id and hist: array<struct(item_id, event_ts)> of bounded length.
    """
    newest = F.array_sort(
        "hist",
        lambda a, b: F.when(a["event_ts"] > b["event_ts"], -1)
        .when(a["event_ts"] < b["event_ts"], 1)
        .when(a["item_id"] < b["item_id"], -1)
        .when(a["item_id"] > b["item_id"], 1)
        .otherwise(0),
    )
    rows = history.select("user_id", F.posexplode(F.slice(newest, 1, shown)).alias("pos", "h")).select(
        "user_id", (F.col("pos") + 1).alias("rank"), "h.item_id", "h.event_ts"
    )
    return rows.join(item_details(metadata), "item_id", "left").withColumns({
        "title": F.coalesce("title", F.lit(UNKNOWN)),
        "image_url": F.coalesce("image_url", F.lit(NO_IMAGE)),
        "categories": F.coalesce("categories", F.array(F.lit(UNKNOWN))),
        "rating": F.coalesce("rating", F.lit(0.0)),
        "reviews": F.coalesce("reviews", F.lit(0).cast("long")),
        "price": F.coalesce("price", F.lit(NO_DETAIL)),
        "store": F.coalesce("store", F.lit(NO_DETAIL)),
    })


def candidate_features(candidates: DataFrame, metadata: DataFrame, stats: DataFrame, stat_columns: Sequence[str]) -> DataFrame:
    """What a ranking model is given for each candidate: the row itself, the item's category, its categories as one
    text, its price as a number and its newest statistics; missing numbers are 0, missing texts empty.

    `metadata` has item_id, main_category, categories and price; `stats` has item_id, ts_ms and the statistics as of
    several times. A candidate that neither knows is dropped. Both are cut to one row per item before the join.
    """
    newest = stats.groupBy("item_id").agg(F.max_by(F.struct(*stat_columns), "ts_ms").alias("__stats"))
    known = metadata.select("item_id", "main_category", "categories", "price").join(newest, "item_id", "full")
    price = F.coalesce(parse_price(F.col("price")), F.lit(0.0))
    numbers = [F.coalesce(F.col(f"__stats.{c}").cast("double"), F.lit(0.0)).alias(c) for c in stat_columns]
    return candidates.join(known, "item_id").select(
        *candidates.columns,
        F.coalesce("main_category", F.lit("")).alias("main_category"),
        F.coalesce(F.array_join("categories", "__"), F.lit("")).alias("categories"),
        price.alias("price"),
        *numbers,
    )


def candidate_rows(
    users: DataFrame, similar: DataFrame, popular_ids: Sequence, cap: int = MAX_CANDIDATES
) -> DataFrame:
    """Candidates per user: similar to the last item, then popular, seen ones left out, at most `cap`.

    `users` holds user_id, last_item and seen (bounded array); `similar` the ranked similar items;
    `popular_ids` the short popular list. Every list is bounded, so a user's candidates are one small array.
    """
    lists = similar.groupBy(F.col("query_id").alias("last_item")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("__similar")
    )
    item_type = users.schema["last_item"].dataType.simpleString()
    popular = F.array(*[F.lit(i).cast(item_type) for i in popular_ids]).cast(f"array<{item_type}>")
    near = F.coalesce(F.col("__similar.item_id"), F.array().cast(f"array<{item_type}>"))
    merged = F.array_except(F.array_distinct(F.concat(near, popular)), F.col("seen"))
    return users.join(lists, "last_item", "left").select(
        "user_id", "last_item", F.posexplode(F.slice(merged, 1, cap)).alias("position", "item_id")
    )
