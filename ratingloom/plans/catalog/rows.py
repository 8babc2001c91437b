"""Sources, projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions import text, times
from ratingloom.operators import clean
from ratingloom.operators.skipgram import positions_of_parts, sequence_parts, sequence_positions
from ratingloom.plans.catalog.base import CUT_MS, SEED, joined, query, scratch
from ratingloom.sources import files, snapshot, views
from ratingloom.sources.changes import decode_changes, encode_changes

PAYLOAD_FIELDS = ("user_id", "item_id", "rating", "timestamp")

SEQUENCES = {
    "ordered": """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, item_id) AS pos,
        count(*) OVER (PARTITION BY user_id) AS n FROM interactions""",
    "positions": "SELECT user_id, pos, item_id FROM ordered WHERE n > 1",
}


@query("src_parquet", "SELECT l_partkey AS item_id, l_quantity AS quantity, epoch_ms(l_shipdate) AS ship_ms FROM lineitem")
def src_parquet(spark, folder):
    df = files.read_parquet(spark, f"{folder}/lineitem.parquet", ["l_partkey", "l_quantity", "l_shipdate"])
    return df.select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        times.epoch_ms(F.col("l_shipdate").cast("timestamp")).alias("ship_ms"),
    )


@query(
    "src_jsonl_sequences",
    "SELECT user_id, CAST(pos AS INTEGER) AS pos, item_id FROM positions",
    SEQUENCES,
)
def src_jsonl_sequences(spark, folder):
    """Sequences written as JSON lines, in parts for long users, and read back as rows."""
    path = scratch(spark, "sequences")
    files.write_sequence_parts(sequence_parts(sequence_positions(views.interactions(spark, folder))), path)
    return positions_of_parts(files.read_sequence_parts(spark, path, "bigint", "bigint"))


def change_records(spark, folder):
    """The events as change records. Records of 'error' events arrive cut off half way."""
    rows = views.stream(spark, folder).withColumns({
        "user_id": F.col("user_id").cast("string"),
        "rating": F.col("value"),
        "timestamp": times.iso_text(F.col("event_ts")),
    }).withColumn("item_id", F.col("item_id").cast("string"))
    encoded = encode_changes(rows, {n: F.col(n) for n in PAYLOAD_FIELDS})
    broken = F.substring("payload", 1, 20)
    return encoded.select(
        "event_id", "ts_ms", F.when(F.col("event_type") == "error", broken).otherwise(F.col("payload")).alias("payload")
    )


CHANGE_SQL = """SELECT event_id, event_type <> 'error' AS readable,
    CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_type <> 'error' THEN CAST(item_id AS VARCHAR) END AS item_id,
    CASE WHEN event_type <> 'error' THEN value END AS rating,
    CASE WHEN event_type <> 'error' THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS timestamp
    FROM stream"""


@query("src_change_stream", CHANGE_SQL)
def src_change_stream(spark, folder):
    good, bad = decode_changes(change_records(spark, folder).drop("ts_ms"))
    return good.withColumn("readable", F.lit(True)).unionByName(
        bad.select("event_id", F.lit(False).alias("readable")), allowMissingColumns=True
    )


@query("sink_parquet", "SELECT user_id, item_id, rating, ts_ms FROM interactions")
def sink_parquet(spark, folder):
    path = scratch(spark, "table")
    files.write_table(views.interactions(spark, folder).drop("event_ts"), path)
    return files.read_parquet(spark, path, ["user_id", "item_id", "rating", "ts_ms"])


LATEST_SQL = """SELECT user_id, item_id, event_id, ts_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS rn FROM stream) WHERE rn = 1"""


@query("sink_latest_snapshot", LATEST_SQL)
def sink_latest_snapshot(spark, folder):
    """Two batches, the newer rows first, then the older ones: the newest row wins all the same."""
    path = scratch(spark, "snapshot")
    rows = views.stream(spark, folder).select("user_id", "item_id", "event_id", "ts_ms")
    middle = rows.agg(((F.min("ts_ms") + F.max("ts_ms")) / 2).cast("long")).scalar()
    for number, part in enumerate((rows.where(F.col("ts_ms") >= middle), rows.where(F.col("ts_ms") < middle))):
        snapshot.upsert_latest(part, number, path, ["user_id"], ["ts_ms", "event_id"])
    return snapshot.read_snapshot(spark, path, ["user_id"], ["ts_ms", "event_id"])


@query("p1_epoch_ms", "SELECT user_id, item_id, ts_ms FROM interactions")
def p1_epoch_ms(spark, folder):
    return views.interactions(spark, folder).select("user_id", "item_id", "ts_ms")


@query(
    "p2_normalise_types",
    """SELECT user_id, item_id, rating, ts_ms // 1000 AS ts_s, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_time
       FROM interactions""",
)
def p2_normalise_types(spark, folder):
    raw = views.interactions(spark, folder).select("user_id", "item_id", F.col("rating").cast("int").alias("rating"), "ts_ms")
    typed = clean.normalise_types(raw)
    return typed.select(
        "user_id", "item_id", "rating", "ts_s", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_time")
    )


# Category text of an item in one of the layouts found in the field, chosen by its size.
CATEGORY_TEXT_SQL = """SELECT p_partkey AS item_id, CASE p_size % 5
    WHEN 0 THEN '{' || p_type || ',"' || p_name || '", ' || p_brand || '}'
    WHEN 1 THEN '["' || p_type || '", "' || p_name || '"]'
    WHEN 2 THEN p_name WHEN 3 THEN '' ELSE NULL END AS raw, p_size % 5 AS layout FROM part"""


@query(
    "p3_parse_categories",
    """SELECT item_id, len(parsed) AS n_categories, array_to_string(parsed, '|') AS categories FROM (
       SELECT item_id, CASE WHEN raw IS NULL OR raw = '' THEN CAST([] AS VARCHAR[])
         WHEN layout = 0 THEN list_transform(string_split(trim(raw, '{}'), ','), lambda v: trim(trim(v), '"'))
         WHEN layout = 1 THEN json_extract_string(raw, '$[*]') ELSE [raw] END AS parsed FROM category_text)""",
    {"category_text": CATEGORY_TEXT_SQL},
)
def p3_parse_categories(spark, folder):
    parts = views.table(spark, folder, "part", "p_partkey", "p_size", "p_type", "p_name", "p_brand")
    layout = F.col("p_size") % 5
    raw = (
        F.when(layout == 0, F.concat(F.lit("{"), "p_type", F.lit(',"'), "p_name", F.lit('", '), "p_brand", F.lit("}")))
        .when(layout == 1, F.concat(F.lit('["'), "p_type", F.lit('", "'), "p_name", F.lit('"]')))
        .when(layout == 2, F.col("p_name"))
        .when(layout == 3, F.lit(""))
    )
    parsed = parts.select(F.col("p_partkey").alias("item_id"), text.parse_categories(raw).alias("c"))
    return parsed.select("item_id", F.size("c").cast("long").alias("n_categories"), joined("c", "|").alias("categories"))


@query(
    "p4_array_literal",
    """SELECT item_id, '{' || array_to_string(list_transform(categories, lambda v: '"' || v || '"'), ', ') || '}' AS literal
       FROM items""",
)
def p4_array_literal(spark, folder):
    return views.items(spark, folder).select("item_id", text.array_literal(F.col("categories")).alias("literal"))


def loose_rows(spark, folder):
    """Interactions joined to loosely typed metadata: some prices are no numbers, some categories are null."""
    parts = views.table(spark, folder, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    meta = parts.select(
        F.col("p_partkey").alias("item_id"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("main_category"),
        F.when(F.col("p_size") % 7 == 0, "None")
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
        .alias("price"),
    )
    return views.interactions(spark, folder).join(meta, "item_id")


LOOSE = {
    "conformed": """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, rating, ts_ms,
        CASE WHEN p_size % 5 <> 0 THEN p_brand ELSE 'None' END AS main_category, p_retailprice AS price
        FROM interactions JOIN part ON item_id = p_partkey WHERE p_size % 7 <> 0"""
}


@query("p5_conform_schema", "SELECT * FROM conformed", LOOSE)
def p5_conform_schema(spark, folder):
    fixed = clean.conform(loose_rows(spark, folder))
    return fixed.withColumn("ts_ms", times.epoch_ms(F.col("event_ts").cast("timestamp"))).drop("event_ts")


@query(
    "p6_fill_required",
    """SELECT i.item_id, i.title, coalesce(CAST(v.label AS INTEGER), 0) AS label,
       CASE WHEN v.item_id IS NULL THEN '' ELSE i.main_category END AS kind, 0.0::DOUBLE AS average_rating
       FROM items i LEFT JOIN vectors v USING (item_id)""",
)
def p6_fill_required(spark, folder):
    known = views.table(spark, folder, "embeddings", "vec_id", "label").select(F.col("vec_id").alias("item_id"), "label")
    rows = views.items(spark, folder).select("item_id", "title", "main_category").join(known, "item_id", "left")
    rows = rows.withColumn("kind", F.when(F.col("label").isNotNull(), F.col("main_category"))).drop("main_category")
    return clean.fill_required(rows, ["average_rating", "label"])


def labelled(spark, folder):
    """Interactions with the source label of their time."""
    source = F.when(F.col("ts_ms") < CUT_MS, "train").otherwise("val")
    return views.interactions(spark, folder).withColumn("source", source)


@query(
    "p7_split_by_source",
    f"""SELECT CASE WHEN ts_ms < {CUT_MS} THEN 'train' ELSE 'val' END AS source, count(*) AS n_rows,
        min(ts_ms) AS min_ts_ms, max(ts_ms) AS max_ts_ms, CAST(sum(rating) AS DOUBLE) AS sum_rating
        FROM interactions GROUP BY 1""",
)
def p7_split_by_source(spark, folder):
    rows = labelled(spark, folder)
    train, val = clean.split_by_source(rows)
    sums = train.agg(F.sum("rating").alias("sum_rating")).withColumn("source", F.lit("train")).unionByName(
        val.agg(F.sum("rating").alias("sum_rating")).withColumn("source", F.lit("val"))
    )
    return clean.source_report(rows).join(sums, "source")


@query(
    "p8_split_by_time",
    """SELECT user_id, item_id, ts_ms, CASE WHEN ts_ms < (SELECT max(ts_ms) + 1000 FROM train) THEN 'train' ELSE 'val' END
       AS part FROM interactions""",
)
def p8_split_by_time(spark, folder):
    rows = views.interactions(spark, folder).select("user_id", "item_id", "ts_ms")
    cutoff = clean.cutoff_after(views.item_ratings(spark, folder).where(F.col("ts_ms") < CUT_MS))
    train, val = clean.split_by_time(rows, cutoff)
    return train.withColumn("part", F.lit("train")).unionByName(val.withColumn("part", F.lit("val")))


@query(
    "p9_holdout_split",
    """SELECT user_id, item_id, ts_ms, event_ts >= (SELECT date_trunc('day', max(event_ts)) - INTERVAL 30 DAY
       FROM interactions) AS held_out FROM interactions""",
)
def p9_holdout_split(spark, folder):
    rows = views.interactions(spark, folder)
    cutoff = clean.holdout_cutoff(views.item_ratings(spark, folder))
    insert, held = clean.split_by_time(rows.select("user_id", "item_id", "ts_ms"), cutoff)
    return insert.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))


@query(
    "p10_key_checks",
    """SELECT 'null' AS problem, c AS key_text, n FROM (SELECT 'user_id' AS c, count(*) FILTER (user_id IS NULL) AS n
         FROM interactions UNION ALL SELECT 'item_id', count(*) FILTER (item_id IS NULL) FROM interactions
         UNION ALL SELECT 'ts_ms', count(*) FILTER (ts_ms IS NULL) FROM interactions)
       UNION ALL SELECT 'duplicate', user_id || '|' || ts_ms, count(*) FROM interactions GROUP BY user_id, ts_ms
       HAVING count(*) > 1""",
)
def p10_key_checks(spark, folder):
    rows = views.interactions(spark, folder)
    nulls = clean.key_nulls(rows, ["user_id", "item_id", "ts_ms"])
    repeats = clean.duplicate_keys(rows, ["user_id", "ts_ms"])
    return nulls.select(F.lit("null").alias("problem"), F.col("column_name").alias("key_text"), F.col("n_nulls").alias("n")).unionByName(
        repeats.select(F.lit("duplicate").alias("problem"), F.concat_ws("|", "user_id", "ts_ms").alias("key_text"), F.col("n_rows").alias("n"))
    )


def enriched(spark, folder):
    return views.interactions(spark, folder).join(views.items(spark, folder), "item_id", "left")


@query(
    "p11_exact_dedup",
    """SELECT user_id, item_id, ts_ms, rating, CASE WHEN item_id % 5 > 0 THEN main_category END AS main_category,
       array_to_string(categories, '|') AS categories, CASE WHEN item_id % 7 > 0 THEN price END AS price,
       count(*) AS copies FROM interactions LEFT JOIN items USING (item_id) GROUP BY ALL""",
)
def p11_exact_dedup(spark, folder):
    """Copies per rating with its item's metadata, some of which is not known."""
    columns = ["user_id", "item_id", "event_ts", "rating", "main_category", "categories", "price"]
    rows = enriched(spark, folder).withColumns({
        "main_category": F.when(F.col("item_id") % 5 > 0, F.col("main_category")),
        "price": F.when(F.col("item_id") % 7 > 0, F.col("price")),
    })
    found = clean.count_copies(rows, columns, carry=["ts_ms"])
    return found.select(
        "user_id", "item_id", "ts_ms", "rating", "main_category", joined("categories", "|").alias("categories"), "price", "copies"
    )


PRICE_TEXT = {
    "price_text": """SELECT p_partkey AS item_id, CASE p_size % 6
        WHEN 0 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
        WHEN 1 THEN 'from ' || p_size || ',234.56 up' WHEN 2 THEN 'None'
        WHEN 3 THEN p_size || '. x' WHEN 4 THEN 'x' || p_size || ' for ' || (p_size + 1) ELSE NULL END AS raw FROM part"""
}


@query(
    "p12_parse_price",
    r"SELECT item_id, TRY_CAST(nullif(regexp_extract(raw, '\b((?:\d+\.\d*)|(?:\d+))\b', 1), '') AS DOUBLE) AS price FROM price_text",
    PRICE_TEXT,
)
def p12_parse_price(spark, folder):
    parts = views.table(spark, folder, "part", "p_partkey", "p_size", "p_retailprice")
    size, kind = F.col("p_size").cast("string"), F.col("p_size") % 6
    raw = (
        F.when(kind == 0, F.concat(F.lit("$"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")))
        .when(kind == 1, F.concat(F.lit("from "), size, F.lit(",234.56 up")))
        .when(kind == 2, F.lit("None"))
        .when(kind == 3, F.concat(size, F.lit(". x")))
        .when(kind == 4, F.concat(F.lit("x"), size, F.lit(" for "), (F.col("p_size") + 1).cast("string")))
    )
    return parts.select(F.col("p_partkey").alias("item_id"), text.parse_price(raw).alias("price"))


@query(
    "p13_safe_numeric",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 0.0 WHEN 'view' THEN 0.0 WHEN 'click' THEN 0.0 ELSE value END AS number,
       CASE event_type WHEN 'error' THEN -1 WHEN 'view' THEN -1 ELSE item_id END AS whole FROM stream""",
)
def p13_safe_numeric(spark, folder):
    rows = views.stream(spark, folder)
    kind = F.col("event_type")
    number = F.when(kind == "error", "None").when(kind == "view", "n/a").when(kind == "click", F.lit(None)).otherwise(
        F.col("value").cast("string")
    )
    whole = F.when(kind == "error", "None").when(kind == "view", F.concat("item_id", F.lit(".5"))).otherwise(
        F.col("item_id").cast("string")
    )
    return rows.select("event_id", text.safe_double(number).alias("number"), text.safe_long(whole, -1).alias("whole"))


BUCKET_CASE = """CASE WHEN {s} < 600 THEN 0 WHEN {s} < 3600 THEN 1 WHEN {s} < 86400 THEN 2 WHEN {s} < 604800 THEN 3
    WHEN {s} < 2592000 THEN 4 WHEN {s} < 31536000 THEN 5 WHEN {s} < 94608000 THEN 6 WHEN {s} < 157680000 THEN 7
    WHEN {s} < 315360000 THEN 8 ELSE 9 END"""


@query(
    "p14_time_bucket",
    f"SELECT event_id, CAST({BUCKET_CASE.format(s='s')} AS INTEGER) AS bucket FROM (SELECT event_id, (1706745600000 - ts_ms) // 1000 * (item_id % 50) AS s FROM stream)",
)
def p14_time_bucket(spark, folder):
    """Ages against 2024-02-01, stretched so that all buckets occur."""
    age = F.floor((F.lit(1706745600000) - F.col("ts_ms")) / 1000) * (F.col("item_id") % 50)
    return views.stream(spark, folder).select("event_id", times.age_bucket(age).alias("bucket"))


@query("p15_binary_label", "SELECT user_id, item_id, ts_ms, rating - 3 AS rating, CAST(rating > 3 AS INTEGER) AS label FROM interactions")
def p15_binary_label(spark, folder):
    rows = views.interactions(spark, folder).withColumn("rating", F.col("rating") - 3)
    return clean.binary_label(rows).drop("event_ts")


@query("p16_sample_rows", f"SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('{SEED}|' || o_orderkey), o_orderkey LIMIT 1000")
def p16_sample_rows(spark, folder):
    return clean.sample_rows(views.table(spark, folder, "orders", "o_orderkey", "o_custkey"), 1000, SEED, ["o_orderkey"])


@query("p17_shuffle_rows", f"SELECT o_orderkey, o_custkey, md5('{SEED}|' || o_orderkey) AS shuffle_key FROM orders")
def p17_shuffle_rows(spark, folder):
    return clean.shuffle_rows(views.table(spark, folder, "orders", "o_orderkey", "o_custkey"), SEED, ["o_orderkey"])
