"""Aggregates over ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.selection import quantiles

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# Fixed value: the time zone in which calendar counts are read.
CALENDAR_ZONE = "US/Eastern"


def time_range(df: DataFrame, at: str = "ts_ms", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(at).alias("min_" + at), F.max(at).alias("max_" + at))


def overlap_stats(train: DataFrame, val: DataFrame) -> DataFrame:
    """One row: distinct users and items, share of val keys known in train, sparsity of train.

    Either table is read once, for both keys; keys are made distinct before the shuffle, so nothing else is sent.
    """
    rows = train.select("user_id", "item_id", F.lit(1).alias("t")).unionByName(val.select("user_id", "item_id", F.lit(0).alias("t")))
    nothing = [F.lit(None).cast(rows.schema[key].dataType).alias(key) for key in ("user_id", "item_id")]
    kinds = F.array(
        F.struct(F.lit("user").alias("kind"), F.col("user_id"), nothing[1]),
        F.struct(F.lit("item").alias("kind"), nothing[0], F.col("item_id")),
    )
    tagged = rows.select("t", F.inline(kinds)).groupBy("kind", "user_id", "item_id").agg(
        F.max("t").alias("t"), F.max(1 - F.col("t")).alias("v"), F.sum("t").alias("n")
    )
    counted = {"train_rows": F.coalesce(F.sum(F.when(F.col("kind") == "user", F.col("n"))), F.lit(0).cast("long"))}
    for short in ("user", "item"):
        for name, value in ((f"train_{short}s", F.col("t")), (f"val_{short}s", F.col("v")), (f"known_{short}s", F.col("t") * F.col("v"))):
            counted[name] = F.sum(F.when(F.col("kind") == short, value))
    one = tagged.agg(*[value.alias(name) for name, value in counted.items()])
    return one.select(
        "train_rows", "train_users", "train_items", "val_users", "val_items",
        F.try_divide("known_users", "val_users").alias("known_user_share"),
        F.try_divide("known_items", "val_items").alias("known_item_share"),
        (1 - F.try_divide(F.col("train_rows"), F.col("train_users").cast("double") * F.col("train_items"))).alias("sparsity"),
    )


def popularity(df: DataFrame) -> DataFrame:
    """Per item: rating count, mean and score = count x (mean - 3)."""
    return (
        df.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count("rating").alias("rating_count"), F.avg("rating").alias("rating_avg"))
        .withColumn("score", F.col("rating_count") * (F.col("rating_avg") - 3.0))
    )


def item_shares(df: DataFrame) -> DataFrame:
    """Row count per item and its share of all rows."""
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.try_divide(F.col("n_rows"), total))


def user_items(df: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs; pairs instead of a set per user keep every row small."""
    return df.select("user_id", "item_id").distinct()


def calendar_counts(df: DataFrame, at: str = "event_ts", zone: str = CALENDAR_ZONE) -> DataFrame:
    """Rows per weekday (1 = Monday), hour and month in local time; every slot present, empty ones 0.

    One pass counts (weekday, hour, month) combinations - at most 2016 groups - and the three calendars
    are read off that table.
    """
    spark = df.sparkSession
    local = F.from_utc_timestamp(at, zone)
    base = df.groupBy(
        (F.weekday(local) + 1).alias("weekday"), F.hour(local).alias("hour"), F.month(local).alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))
    counted = (
        base.select(F.explode(F.array(*[
            F.struct(F.lit(u).alias("unit"), F.col(u).alias("slot"), F.col("n")) for u in ("weekday", "hour", "month")
        ])).alias("c"))
        .groupBy("c.unit", "c.slot")
        .agg(F.sum("c.n").alias("n_rows"))
    )
    ranges = [("weekday", 1, 8), ("hour", 0, 24), ("month", 1, 13)]
    slots = spark.createDataFrame([(u, s) for u, a, b in ranges for s in range(a, b)], "unit string, slot int")
    return slots.join(counted, ["unit", "slot"], "left").na.fill(0, ["n_rows"])


def basket_frequency(df: DataFrame) -> DataFrame:
    """Per item: in how many users' sequences it occurs."""
    return user_items(df).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_sequences"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct, mean, deviation, min, quartiles and max per numeric column, long form.

    Quartiles are exact, linear between neighbours, and no task holds the values of a column.
    """
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75))
    packed = []
    for c in columns:
        v = F.col(c).cast("double")
        packed += [F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.count_distinct(c).alias("n_distinct"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c])],
            F.max(v).alias("max"),
        ).alias(c)]
    return df.agg(*packed).select(F.inline(F.array(*[F.col(c) for c in columns])))


def most_common(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value and its count."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), column).limit(1)


def weighted_bce(df: DataFrame, label: str, probability: str, positive_weight: float | Column) -> DataFrame:
    """Mean of w x cross-entropy, w = the weight on positives, else 1; logarithms are cut at -100."""
    y = F.col(label).cast("double")
    p = F.col(probability)

    def log(x: Column) -> Column:
        return F.greatest(F.coalesce(F.ln(x), F.lit(-100.0)), F.lit(-100.0))

    weight = F.when(y > 0, F.lit(positive_weight) if not isinstance(positive_weight, Column) else positive_weight)
    loss = -(y * log(p) + (1 - y) * log(1 - p)) * weight.otherwise(1.0)
    return df.agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("n_rows"))
