"""Dictionaries, encoders, vectors and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.times import HISTORY_LENGTH, PADDING, left_pad
from ratingloom.functions.vectors import unit
from ratingloom.operators import models, sequence_ranker
from ratingloom.operators.dictionary import build_dictionary, map_ids, sequence_to_index
from ratingloom.operators.encoders import (
    item_features,
    CategoryCounts,
    ScaledPrice,
    Standardised,
    category_entries,
    item_entries,
    level_table,
    one_hot_entries,
    term_counts,
    term_vocabulary,
    tfidf,
)
from ratingloom.operators.skew import find_cuts
from ratingloom.operators.skipgram import both_ways, sequence_positions, skipgram_negatives, skipgram_pairs, unordered_pairs
from ratingloom.operators.skipgram_model import labelled_counts, learn_item_vectors
from ratingloom.operators.stats import basket_frequency, user_items
from ratingloom.plans import feature_job
from ratingloom.plans.catalog.base import CUT_MS, joined, query, rounded
from ratingloom.plans.catalog.ranking import DIMENSION
from ratingloom.plans.catalog.rows import SEQUENCES
from ratingloom.plans.catalog.windows import HISTORY, ITEM_STATS, item_stats, sequence_rows
from ratingloom.session import durable
from ratingloom.sources import views

DICTIONARY_SQL = "SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS idx FROM (SELECT DISTINCT {key} FROM {view})"


@query(
    "m1_id_dictionary",
    f"""SELECT 'user_id' AS key_name, user_id AS id, idx FROM ({DICTIONARY_SQL.format(key='user_id', view='interactions')})
        UNION ALL SELECT 'item_id', item_id, idx FROM ({DICTIONARY_SQL.format(key='item_id', view='interactions')})""",
)
def m1_id_dictionary(spark, folder):
    rows = views.interactions(spark, folder)
    parts = [
        build_dictionary(rows, key).select(F.lit(key).alias("key_name"), F.col(key).alias("id"), "idx")
        for key in ("user_id", "item_id")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "m2_map_ids",
    """SELECT i.user_id, i.item_id, i.ts_ms, coalesce(u.idx, (SELECT count(*) FROM users)) AS user_indice,
       coalesce(d.idx, (SELECT count(*) FROM known_items)) AS item_indice FROM interactions i LEFT JOIN users u USING (user_id)
       LEFT JOIN known_items d USING (item_id)""",
    {
        "early": "SELECT * FROM interactions WHERE ts_ms < 820454400000",
        "users": DICTIONARY_SQL.format(key="user_id", view="early"),
        "known_items": DICTIONARY_SQL.format(key="item_id", view="early"),
    },
)
def m2_map_ids(spark, folder):
    """Indices fitted on the ratings before 1996; later users and items are unknown."""
    rows = views.interactions(spark, folder).select("user_id", "item_id", "ts_ms")
    early = rows.where(F.col("ts_ms") < 820_454_400_000)
    for key, name in (("user_id", "user_indice"), ("item_id", "item_indice")):
        dictionary = build_dictionary(early, key)
        rows = map_ids(rows, dictionary, key, name, dictionary.count())
    return rows


@query(
    "m3_sequence_to_index",
    """SELECT user_id, item_id, ts_ms, array_to_string(list_concat(list_transform(range(10 - coalesce(len(hist_items), 0)),
       lambda i: CAST(-1 AS BIGINT)), coalesce(seq, [])), ',') AS item_sequence FROM longest LEFT JOIN (
       SELECT user_id, event_ts, list(coalesce(idx, (SELECT count(*) FROM known_items)) ORDER BY p) AS seq FROM (
         SELECT user_id, event_ts, unnest(hist_items) AS h, generate_subscripts(hist_items, 1) AS p FROM longest)
       LEFT JOIN known_items k ON h = k.item_id GROUP BY 1, 2) USING (user_id, event_ts)""",
    {**HISTORY, "known_items": DICTIONARY_SQL.format(key="item_id", view="(SELECT * FROM interactions WHERE ts_ms < 820454400000)")},
)
def m3_sequence_to_index(spark, folder):
    """Indices of the ten previous items. Each rating looks its item up once, before the histories are built."""
    known = build_dictionary(views.interactions(spark, folder).where(F.col("ts_ms") < 820_454_400_000), "item_id")
    rows = sequence_rows(spark, folder)
    indexed = map_ids(rows, known, "item_id", "item_idx", known.count())
    cuts = find_cuts(rows, "user_id", "ts_ms")
    history = feature_job.user_history(indexed, cuts, mark_last=True, carry=["item_idx"])
    sequence = left_pad(F.col("hist.item_idx"), HISTORY_LENGTH, F.lit(PADDING).cast("long"))
    return feature_job.longest_per_user_ts(history).select(
        "user_id", "item_id", "ts_ms", joined(sequence).alias("item_sequence")
    )


@query(
    "m3_stored_sequences",
    """SELECT user_id, array_to_string(list_concat(list_transform(range(10 - len(seq)), lambda i: CAST(-1 AS BIGINT)), seq), ',')
       AS item_sequence FROM (SELECT user_id, list(coalesce(idx, (SELECT count(*) FROM known_items)) ORDER BY back DESC) AS seq
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_ts DESC, item_id DESC) AS back
       FROM sequence_rows) LEFT JOIN known_items USING (item_id) WHERE back <= 10 GROUP BY user_id)""",
    {**HISTORY, "known_items": DICTIONARY_SQL.format(key="item_id", view="(SELECT * FROM interactions WHERE ts_ms < 820454400000)")},
)
def m3_stored_sequences(spark, folder):
    """Indices of histories that are already stored as lists: the newest ten items of every user."""
    known = build_dictionary(views.interactions(spark, folder).where(F.col("ts_ms") < 820_454_400_000), "item_id")
    stored = feature_job.current_history(sequence_rows(spark, folder)).select("user_id", F.col("hist.item_id").alias("recent"))
    full = sequence_to_index(stored, ["user_id"], "recent", known, known.count())
    return full.select("user_id", joined("item_sequence").alias("item_sequence"))


# Items with the statistics of their first row; fitted on the items seen before the cut.
FRAME: dict[str, str] = {
    **ITEM_STATS,
    "frame": """SELECT f.*, i.main_category, i.categories, i.price,
        CAST(regexp_extract(i.price, '[0-9]+[.][0-9]+') AS DOUBLE) AS amount FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts_ms DESC) AS rn FROM item_stats) f
        JOIN items i USING (item_id) WHERE rn = 1""",
    "fit": "SELECT f.* FROM frame f SEMI JOIN (SELECT item_id FROM item_stats WHERE ts_ms < 820454400000) e USING (item_id)",
}


def encoder_frame(spark, folder):
    """(all items, fit items): newest statistics row per item with metadata."""
    stats = item_stats(spark, folder)
    row = F.struct("ts_ms", "rating", *feature_job.ITEM_STAT_COLUMNS)
    newest = stats.groupBy("item_id").agg(F.max_by(row, "ts_ms").alias("r"), F.min("ts_ms").alias("first_ms"))
    metadata = views.items(spark, folder).drop("title")
    frame = durable(newest.select("item_id", "r.*", "first_ms").join(metadata, "item_id"))
    return frame, frame.where(F.col("first_ms") < 820_454_400_000)


@query(
    "m4_one_hot",
    """SELECT item_id, rank - 1 AS pos, 1.0::DOUBLE AS value FROM frame JOIN (SELECT c, row_number() OVER (ORDER BY c) AS rank
       FROM (SELECT DISTINCT main_category AS c FROM fit)) ON c = main_category""",
    FRAME,
)
def m4_one_hot(spark, folder):
    """The place of the one in every item's one-hot category."""
    frame, fit = encoder_frame(spark, folder)
    return one_hot_entries(frame, level_table(fit.select("main_category")), "item_id", "main_category")


@query(
    "m5_category_counts",
    """SELECT item_id, rank - 1 AS pos, count(*)::DOUBLE AS value FROM (SELECT item_id, lower(unnest(categories)) AS c FROM frame)
       JOIN (SELECT c, row_number() OVER (ORDER BY c) AS rank FROM (SELECT DISTINCT lower(unnest(categories)) AS c FROM fit))
       USING (c) GROUP BY ALL""",
    FRAME,
)
def m5_category_counts(spark, folder):
    """How often each category occurs in an item's list, as sparse entries."""
    frame, fit = encoder_frame(spark, folder)
    levels = level_table(fit.select(F.explode(CategoryCounts.tokens("categories"))))
    return category_entries(frame, levels, "item_id", "categories")


@query(
    "m6_price_scaled",
    """SELECT item_id, round((amount - (SELECT min(amount) FROM fit)) / (SELECT max(amount) - min(amount) FROM fit), 6) AS price_scaled
       FROM frame""",
    FRAME,
)
def m6_price_scaled(spark, folder):
    frame, fit = encoder_frame(spark, folder)
    return frame.select("item_id", rounded(ScaledPrice.fit(fit, "price")()).alias("price_scaled"))


def _z_sql(c: str) -> str:
    v = f"coalesce(CAST({c} AS DOUBLE), 0)"
    return (
        f"round(({v} - (SELECT avg({v}) FROM fit)) / (SELECT CASE WHEN stddev_pop({v}) = 0 THEN 1 ELSE stddev_pop({v}) END"
        f" FROM fit), 6) + 0.0 AS {c}"
    )


@query("m7_rating_standardised", f"SELECT item_id, {', '.join(_z_sql(c) for c in feature_job.ITEM_STAT_COLUMNS)} FROM frame", FRAME)
def m7_rating_standardised(spark, folder):
    frame, fit = encoder_frame(spark, folder)
    scaler = Standardised.fit(fit, feature_job.ITEM_STAT_COLUMNS)
    return frame.select("item_id", *[rounded(v).alias(c) for c, v in zip(scaler.columns, scaler.each())])


_STAT_PARTS = " UNION ALL ".join(
    f"SELECT item_id, 1000000 + {i} AS part, coalesce(CAST({c} AS DOUBLE), 0) AS v FROM frame"
    for i, c in enumerate(feature_job.ITEM_STAT_COLUMNS)
)


@query(
    "m8_item_vector",
    """SELECT item_id, pos, round((v - m) / CASE WHEN d < 1e-9 THEN 1 ELSE d END, 5) + 0.0 AS value FROM long_form
       JOIN parts USING (part) WHERE v <> 0 OR part >= 500000""",
    {
        **FRAME,
        "long_form": f"""SELECT item_id, rank AS part, CASE WHEN c = main_category THEN 1.0 ELSE 0.0 END AS v FROM frame,
            (SELECT c, row_number() OVER (ORDER BY c) AS rank FROM (SELECT DISTINCT main_category AS c FROM fit))
            UNION ALL SELECT item_id, 1000 + rank, len(list_filter(categories, lambda t: lower(t) = c)) FROM frame,
            (SELECT c, row_number() OVER (ORDER BY c) AS rank FROM (SELECT DISTINCT lower(unnest(categories)) AS c FROM fit))
            UNION ALL SELECT item_id, 500000, amount FROM frame UNION ALL {_STAT_PARTS}""",
        "parts": """SELECT part, dense_rank() OVER (ORDER BY part) - 1 AS pos, avg(v) AS m, stddev_pop(v) AS d FROM long_form
            SEMI JOIN fit USING (item_id) GROUP BY part""",
    },
)
def m8_item_vector(spark, folder):
    """All encoders side by side, standardised, as sparse entries."""
    frame, fit = encoder_frame(spark, folder)
    entries = item_entries(frame, fit, "item_id", feature_job.ITEM_STAT_COLUMNS)
    return entries.withColumn("value", rounded("value", 5))


TERMS: dict[str, str] = {
    "words": r"SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents",
    "grams": """SELECT doc_id, unnest(w) AS term FROM words UNION ALL
        SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words""",
    "counted": "SELECT doc_id, term, count(*) AS n FROM grams GROUP BY ALL",
    "vocabulary": """SELECT term, df, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM (
        SELECT term, count(*) AS df, sum(n) AS total FROM counted GROUP BY term) WHERE df >= 5 ORDER BY total DESC, term LIMIT 1000""",
    "weighted": "SELECT doc_id, term, n * idf AS w FROM counted JOIN vocabulary USING (term)",
}


@query(
    "m9_text_tfidf",
    """SELECT doc_id, term, round(w / l, 6) AS weight FROM weighted JOIN (SELECT doc_id, sqrt(sum(w * w)) AS l FROM weighted
       GROUP BY doc_id) USING (doc_id)""",
    TERMS,
)
def m9_text_tfidf(spark, folder):
    documents = views.table(spark, folder, "documents", "doc_id", "text")
    counts = term_counts(documents, "doc_id", "text")
    vocabulary = durable(term_vocabulary(counts, documents.agg(F.count(F.lit(1))).scalar()))
    return tfidf(counts, vocabulary, "doc_id").withColumn("weight", rounded("weight"))


@query("m14_item_embeddings")
def m14_item_embeddings(spark, folder):
    """Item vectors learned from the skip-gram pairs and their negatives. Items are numbered in sequences, before there
    are pairs; the numbers sort as the items do, so the same negatives are drawn."""
    named = durable(sequence_positions(views.interactions(spark, folder)))
    dictionary = durable(build_dictionary(named, "item_id"))
    positions = durable(named.join(dictionary, "item_id", "left").select("user_id", "pos", F.col("idx").alias("item_id")))
    grouped = skipgram_pairs(positions, grouped=True)
    negatives = skipgram_negatives(grouped, user_items(positions), basket_frequency(positions))
    counts = labelled_counts(skipgram_pairs(positions), negatives)
    vectors = learn_item_vectors(counts, dimension=16, epochs=3, dictionary=dictionary)
    return vectors.select("item_id", F.posexplode("vector").alias("pos", "value")).withColumn("value", rounded("value"))


PAIR_SCORES = {
    **SEQUENCES,
    "pairs": """SELECT DISTINCT a.item_id AS target, b.item_id AS context FROM positions a JOIN positions b
        ON a.user_id = b.user_id AND b.pos BETWEEN a.pos - 3 AND a.pos + 3 AND a.pos <> b.pos""",
}
PAIR_SCORE_SQL = """SELECT target, context, round(1 / (1 + exp(-list_dot_product(a.vector, b.vector))), 6) AS score FROM pairs
    JOIN vectors a ON target = a.item_id JOIN vectors b ON context = b.item_id"""


def scored_pairs(spark, folder):
    """The different pairs of items that have vectors, in one direction: a product is the same in both.

    The other items lose their names on the ratings, before there are pairs, and keep their places.
    """
    known = views.vectors(spark, folder).select("item_id")
    return unordered_pairs(skipgram_pairs(sequence_positions(views.interactions(spark, folder), known)))


@query("m15_pair_score", PAIR_SCORE_SQL, PAIR_SCORES)
def m15_pair_score(spark, folder):
    scores = models.pair_scores(scored_pairs(spark, folder), views.vectors(spark, folder).select("item_id", "vector"))
    return both_ways(scores).withColumn("score", rounded("score"))


@query("m16_batch_score", PAIR_SCORE_SQL, PAIR_SCORES)
def m16_batch_score(spark, folder):
    """The same scores from the pluggable batch scorer."""
    scores = models.batch_score(scored_pairs(spark, folder), keep=["target", "context"], vectors=views.vectors(spark, folder))
    return both_ways(scores).withColumn("score", rounded("score"))


@query("m17_ranker")
def m17_ranker(spark, folder):
    """Ranker on item features and the history place by place, fitted on the training rows, with positives weighted by
    the sampling ratio; scores of the validation rows."""
    from ratingloom.plans.catalog.sampling import RANKER_RATIO, ranker_rows

    rows = durable(ranker_rows(spark, folder).withColumn("__row", F.monotonically_increasing_id()))
    frame, fit = encoder_frame(spark, folder)
    entries = item_features(frame, fit, "item_id", feature_job.ITEM_STAT_COLUMNS)
    table = sequence_ranker.sparse_rows(rows, entries, views.vectors(spark, folder), keep=["user_id", "item_id", "ts_ms", "label"])
    table = durable(table)
    model = sequence_ranker.fit(table.where(F.col("ts_ms") < CUT_MS), "label", positive_weight=float(RANKER_RATIO))
    scored = sequence_ranker.score(model, table.where(F.col("ts_ms") >= CUT_MS))
    return scored.select("user_id", "item_id", "ts_ms", "label", rounded("score").alias("score"))


@query(
    "m18_unit_vectors",
    """SELECT item_id, CAST(p - 1 AS INTEGER) AS pos, round(v, 6) + 0.0 AS value FROM (SELECT item_id, generate_subscripts(vector, 1) AS p,
       unnest(vector) / sqrt(list_dot_product(vector, vector)) AS v FROM vectors)""",
)
def m18_unit_vectors(spark, folder):
    vectors = views.vectors(spark, folder)
    return vectors.select("item_id", F.posexplode(unit(F.col("vector"))).alias("pos", "value")).withColumn("value", rounded("value"))


@query(
    "m20_embedding_table",
    f"""SELECT idx, item_id, CAST(p - 1 AS INTEGER) AS pos, v AS value FROM (SELECT idx, item_id, unnest(vec) AS v,
        generate_subscripts(vec, 1) AS p FROM (SELECT idx, item_id, coalesce(vector, list_transform(range({DIMENSION}),
        lambda i: 0.0::DOUBLE)) AS vec FROM (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM items)
        LEFT JOIN vectors USING (item_id)))""",
)
def m20_embedding_table(spark, folder):
    dictionary = build_dictionary(views.items(spark, folder), "item_id")
    full = models.embedding_table(dictionary, views.vectors(spark, folder), DIMENSION)
    return full.select("idx", "item_id", F.posexplode("vector").alias("pos", "value"))
