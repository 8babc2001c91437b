import itertools
import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators.asof import asof_join
from ratingloom.operators.ordered import numbered, previous_rows
from ratingloom.operators.skew import find_cuts
from ratingloom.operators.trailing import trailing_stats
from ratingloom.plans import feature_job

DAY = 86_400_000
NAMES = {n: (f"c{n}", f"a{n}") for n in (7, 30, 90, 365)}


def stats(spark, rows, min_rows):
    df = spark.createDataFrame(rows, "k long, t long, v double")
    cuts = find_cuts(df, "k", "t", min_rows)
    found = trailing_stats(df, "k", "t", "v", (7, 30, 90, 365), NAMES, cuts)
    return sorted(tuple(r) for r in found.select("k", "t", "v", *[c for n in NAMES.values() for c in n]).collect())


def brute(rows):
    out = []
    for k, t, v in rows:
        line = [k, t, v]
        for n in NAMES:
            seen = [w for q, s, w in rows if q == k and t - n * DAY <= s <= t - 1]
            line += [len(seen), sum(seen) / len(seen) if seen else None]
        out.append(tuple(line))
    return sorted(out)


@pytest.mark.parametrize("min_rows", [10**6, 3])
def test_window_edges(spark, min_rows):
    base = 400 * DAY
    rows = [(1, base, 4.0)]
    for n in (7, 30, 90, 365):
        rows += [(1, base - n * DAY, 2.0), (1, base - n * DAY - 1000, 1.0)]
    rows += [(1, base, 5.0), (1, base - 1000, 3.0), (2, base, 1.0)]
    assert stats(spark, rows, min_rows) == brute(rows)


def test_one_key_with_most_rows(spark):
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 6), rng.randrange(500) * DAY // 2, float(rng.randrange(1, 6)))
            for _ in range(400)]
    assert stats(spark, rows, 20) == stats(spark, rows, 10**6) == brute(rows)


def test_cuts_are_found_only_for_large_keys(spark):
    df = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 1)], "k long, t long")
    assert find_cuts(df, "k", "t", 100) is None
    cuts = find_cuts(df, "k", "t", 10)
    assert [r["k"] for r in cuts.table.collect()] == [1]
    sizes = [r["count"] for r in cuts.heavy(df).groupBy("__piece").count().collect()]
    assert sum(sizes) == 100 and max(sizes) <= 20 and len(sizes) >= 8
    assert cuts.light(df).count() == 1


@pytest.mark.parametrize("min_rows", [10**6, 4])
def test_history_and_numbering(spark, min_rows):
    rows = [(u, t, 100 * u + t) for u, n in ((1, 9), (2, 10), (3, 11), (4, 12), (5, 1), (6, 40)) for t in range(n)]
    df = spark.createDataFrame(rows, "u long, t long, i long")
    cuts = find_cuts(df, "u", "t", min_rows)
    order = [F.col("t"), F.col("i")]
    history = previous_rows(df, "u", order, F.col("i"), 10, "h", cuts)
    for r in history.collect():
        mine = [i for u, t, i in rows if u == r["u"] and t < r["t"]]
        assert r["h"] == mine[-10:]
    placed = numbered(df, "u", [F.asc("t")], "pos", cuts)
    assert all(r["pos"] == r["t"] + 1 for r in placed.collect())


def test_longest_history_per_moment(spark):
    rows = [(1, "2020-01-01", 5), (1, "2020-01-01", 7), (1, "2020-01-01", 6), (1, "2020-01-02", 9)]
    df = spark.createDataFrame(rows, "user_id long, d string, item_id long").select(
        "user_id", "item_id", F.col("d").cast("timestamp").alias("event_ts"),
        (F.unix_seconds(F.col("d").cast("timestamp")) * 1000).alias("ts_ms"),
    ).withColumn("rating", F.lit(3.0))
    found = {r["ts_ms"]: r for r in feature_job.user_features(df).collect()}
    assert len(found) == 2
    first, second = (found[t] for t in sorted(found))
    assert first["item_id"] == 7 and first["recent_items"] == [5, 6]
    assert second["recent_items"] == [5, 6, 7]
    assert second["item_sequence_ts_bucket"] == [-1] * 7 + [3] * 3
    assert (first["user_rating_cnt_90d"], first["user_rating_avg_90d"]) == (0, None)
    assert (second["user_rating_cnt_90d"], second["user_rating_avg_90d"]) == (3, 3.0)


@pytest.mark.parametrize("split", [False, True])
def test_asof(spark, split):
    if split:
        spark.conf.set("spark.ratingloom.skew.minRows", "2")
    try:
        features = [(1, t * DAY, float(t)) for t in (1, 5, 40)] + [(2, 100 * DAY, 9.0)]
        asks = [(k, t * DAY) for k, t in itertools.product((1, 2, 3), (0, 1, 4, 5, 6, 35, 36, 40, 70, 100))]
        found = asof_join(
            spark.createDataFrame(asks + asks, "k long, t long"),
            spark.createDataFrame(features, "k long, f long, v double"), "k", "t", "f", ["v"], ttl_days=30,
        )
        got = {(r["k"], r["t"]): r["v"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.ratingloom.skew.minRows")
    assert len(got) == len(asks)
    for k, t in asks:
        fits = [(f, v) for q, f, v in features if q == k and f <= t and f >= t - 30 * DAY]
        newest = max((f for q, f, v in features if q == k and f <= t), default=None)
        expected = max(fits)[1] if fits and max(fits)[0] == newest else None
        assert got[(k, t)] == expected


def test_feature_job_writes_only_clean_tables(spark, tmp_path):
    rows = []
    for source, days in (("train", range(1, 20)), ("val", range(20, 25))):
        for d in days:
            rows.append((d % 3, d % 4, float(d % 5 + 1), d * DAY, "Toys", '{"a","b"}', "$1.00", source))
    df = spark.createDataFrame(
        rows + rows[:2],
        "user_id long, item_id long, rating double, ts_ms long, main_category string, categories string, price string, source string",
    ).withColumn("event_ts", F.timestamp_millis("ts_ms"))
    paths = feature_job.run_feature_job(df, str(tmp_path / "good"))
    assert spark.read.parquet(paths["train"]).count() == 19
    items = spark.read.parquet(paths["item_stats"])
    assert items.count() == 24 and items.first()["categories"] == ["a", "b"]
    broken = df.withColumn("rating", F.lit(9.0))
    with pytest.raises(ValueError, match="failed rules"):
        feature_job.run_feature_job(broken, str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
    with pytest.raises(ValueError, match="not in train"):
        feature_job.run_feature_job(df.where("source = 'val' OR user_id > 0"), str(tmp_path / "bad"))


def test_means_are_of_the_rows_with_a_value(spark, split_everything):
    """Null, NaN and infinite values count as rows, not as values; with and without pieces."""
    from ratingloom.operators.trailing import trailing_stats

    values = [4.0, None, float("nan"), 2.0, float("inf"), 5.0]
    rows = [(1, 1000 * (i + 1), v) for i, v in enumerate(values)] + [(2, 1000, None), (2, 2000, 3.0)]
    frame = spark.createDataFrame(rows, "k long, at long, v double")
    names = {7: ("n", "mean")}
    for cuts in (None, find_cuts(frame, "k", "at")):
        got = {(r.k, r.at): (r.n, r["mean"]) for r in trailing_stats(frame, "k", "at", "v", [7], names, cuts).collect()}
        assert got[(1, 1000)] == (0, None) and got[(1, 2000)] == (1, 4.0) and got[(1, 4000)] == (3, 4.0)
        assert got[(1, 6000)] == (5, 3.0) and got[(2, 2000)] == (1, None)


def test_pieces_keep_their_size_when_the_table_grows(spark):
    from ratingloom.operators.skew import PIECE

    largest = {}
    for rows in (2_000, 20_000):
        frame = spark.range(rows).selectExpr("id % 2 AS k", "id AS at")
        cuts = find_cuts(frame, "k", "at", min_rows=200)
        pieces = cuts.heavy(frame).groupBy("k", PIECE).count().collect()
        assert sum(p["count"] for p in pieces) == rows
        largest[rows] = max(p["count"] for p in pieces)
    assert largest[20_000] <= 1.5 * largest[2_000] <= 1.5 * 1.5 * 200
