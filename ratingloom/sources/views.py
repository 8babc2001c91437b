"""The four base views every job reads, built over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions.times import epoch_ms
from ratingloom.session import configure


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Parquet table with only the named columns, so the scan reads nothing else."""
    df = configure(spark).read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings: user_id, item_id, rating, event_ts (UTC) and ts_ms (second resolution)."""
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    event_ts = F.col("l_shipdate").cast("timestamp")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.lit(1) + F.floor("l_quantity") % 5).cast("double").alias("rating"),
        event_ts.alias("event_ts"),
        epoch_ms(event_ts).alias("ts_ms"),
    )


def item_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """item_id, rating, ts_ms only: needs no join to learn the user."""
    event_ts = F.col("l_shipdate").cast("timestamp")
    return table(spark, folder, "lineitem", "l_partkey", "l_quantity", "l_shipdate").select(
        F.col("l_partkey").alias("item_id"),
        (F.lit(1) + F.floor("l_quantity") % 5).cast("double").alias("rating"),
        event_ts.alias("event_ts"),
        epoch_ms(event_ts).alias("ts_ms"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Item metadata: item_id, title, main_category, categories, price (text)."""
    words = F.split("p_name", " ")
    return table(spark, folder, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("main_category"),
        F.array("p_type", F.get(words, 0), F.get(words, 1)).alias("categories"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("price"),
    )


def stream(spark: SparkSession, folder: str) -> DataFrame:
    """Change events: event_id, user_id, item_id (from the JSON text), event_type, value, event_ts, ts_ms."""
    event_ts = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        "event_type",
        "value",
        event_ts.alias("event_ts"),
        epoch_ms(event_ts).alias("ts_ms"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Item vectors in double precision: item_id, vector, label."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        "label",
    )
