"""The ranker against popularity on held-out rows, and its loss against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators.sequence_ranker import WIDTH, _slope, fit, score, sparse_rows


def auc(rows, column):
    rows = sorted(rows, key=lambda r: r[column])
    rank = {}
    for i, r in enumerate(rows):
        rank.setdefault(r[column], []).append(i + 1)
    good = [sum(rank[r[column]]) / len(rank[r[column]]) for r in rows if r["label"]]
    bad = len(rows) - len(good)
    return (sum(good) - len(good) * (len(good) + 1) / 2) / (len(good) * bad)


def history_rows(spark, n=1500, groups=8, size=30):
    """Each user stays with one group of items; the negative is an item of any group, popular ones more often."""
    rng = random.Random(4)
    rows = []
    for u in range(n):
        group = rng.randrange(groups)
        seen = [group * size + rng.randrange(size) for _ in range(rng.choice([0, 1, 3, 10]))]
        day = 100 + u % 50
        for label in (1, 0):
            item = group * size + rng.randrange(size) if label else rng.randrange(groups) * size + min(rng.randrange(size), rng.randrange(size))
            rows.append((u, item, day, label, [(i, day - len(seen) + k) for k, i in enumerate(seen)]))
    df = spark.createDataFrame(rows, "user_id long, item_id long, day int, label int, seen array<struct<item_id:long,day:int>>")
    return df.select(
        "user_id", "item_id", (F.col("day") * F.lit(86_400_000).cast("long")).alias("ts_ms"), "label",
        F.transform("seen", lambda s: F.struct(s.item_id.alias("item_id"), F.timestamp_seconds(s.day * 86_400).alias("event_ts"))).alias("hist"),
    )


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(8, 12))
    vectors = [(i, [float(x) for x in middle[i // 30] + 0.4 * rng.normal(size=12)]) for i in range(240) if i % 11]
    vectors = spark.createDataFrame(vectors, "item_id long, vector array<double>")
    # 25,000 categories, one of them for each item and many for none
    entries = spark.createDataFrame([(i, 100 * i, 1.0) for i in range(240)] + [(i, 25_000, i / 240) for i in range(240)], "item_id long, pos long, value double")
    rows = sparse_rows(history_rows(spark), entries, vectors, ["user_id", "item_id", "ts_ms", "label"])
    collected = rows.collect()
    return spark.createDataFrame(collected, rows.schema)


def test_better_than_popularity_on_held_out_users(spark, table):
    model = fit(table.where("user_id % 3 > 0"), "label", 1.0)
    held = [r.asDict() for r in score(model, table.where("user_id % 3 = 0")).collect()]
    counts = {r.item_id: r["count"] for r in table.where("user_id % 3 > 0 AND label = 1").groupBy("item_id").count().collect()}
    for r in held:
        r["popularity"] = counts.get(r["item_id"], 0)
    assert set(held[0]) == {"user_id", "item_id", "ts_ms", "label", "score", "popularity"}
    assert auc(held, "score") > auc(held, "popularity") + 0.1 and auc(held, "score") > 0.75


def test_slope_is_that_of_the_loss(spark, table):
    rows = table.limit(200).withColumns({"y": F.col("label").cast("double"), "w": F.lit(2.0)})
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    model = np.random.default_rng(1).normal(size=WIDTH) * 0.1
    loss, slope, _ = _slope(rows, model)
    data = [(np.array(r.places), np.array(r["values"]), r.y) for r in rows.collect()]

    def brute(m):
        total = sum(2 * (np.logaddexp(0, v @ m[p]) - y * (v @ m[p])) for p, v, y in data)
        return total + m @ m / 2

    assert abs(loss - brute(model)) < 1e-6 * abs(loss)
    for p in list({int(x) for places, _, _ in data for x in places})[:5]:
        step = np.zeros(WIDTH)
        step[p] = 1e-5
        assert abs((brute(model + step) - brute(model - step)) / 2e-5 - slope[p]) < 1e-3


def test_rows_without_history_vectors_or_entries(spark):
    rows = spark.createDataFrame(
        [(1, 5, 0, 1, []), (1, 5, 0, 1, []), (2, 6, 0, 0, [(7, 0)])],
        "user_id long, item_id long, ts_ms long, label int, seen array<struct<item_id:long,s:long>>",
    ).withColumn("hist", F.transform("seen", lambda s: F.struct(s.item_id.alias("item_id"), F.timestamp_seconds(s.s).alias("event_ts"))))
    none = spark.createDataFrame([], "item_id long, pos long, value double")
    vectors = spark.createDataFrame([], "item_id long, vector array<double>")
    found = sparse_rows(rows, none, vectors, ["user_id", "label"])
    assert [len(r.places) for r in found.collect()] == [1, 1, 1]
    scored = score(fit(found, "label", 1.0), found).collect()
    assert len(scored) == 3 and all(0.5 < r.score < 0.8 for r in scored)
    assert score(fit(found.limit(0), "label", 1.0), found.limit(0)).count() == 0


def test_vectors_are_not_joined_to_the_history(spark, monkeypatch):
    """Each pair of an item and one that was seen took both vectors through two shuffles, known or not."""
    from ratingloom.operators import sequence_ranker

    # 2 has two vectors, 4 none, 5 a null in it, 6 another length
    vectors = [(1, [3.0, 4.0]), (2, [0.0, 2.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(vectors, "item_id long, vector array<double>")
    rows = spark.createDataFrame(
        [(1, 1, 0, [(i, 0) for i in (9, 2, 1, 3, None)]), (2, 9, 0, [(1, 0)]), (3, None, 0, [(1, 0)]), (4, 5, 0, [(1, 0), (6, 0)]), (5, 2, 0, [])],
        "user_id long, item_id long, ts_ms long, seen array<struct<item_id:long,s:long>>",
    ).withColumn("hist", F.transform("seen", lambda s: F.struct(s.item_id.alias("item_id"), F.timestamp_seconds(s.s).alias("event_ts"))))
    none = spark.createDataFrame([], "item_id long, pos long, value double")
    asked = []
    tiles = sequence_ranker.in_tiles
    monkeypatch.setattr(sequence_ranker, "in_tiles", lambda pairs, *more: (asked.append(pairs), tiles(pairs, *more))[1])
    found = {r.user_id: list(r["values"]) for r in sparse_rows(rows, none, vectors, ["user_id"]).collect()}
    # the constant, and twice each likeness: by place and by age
    assert sorted(found[1]) == sorted([1.0, *[0.8] * 2, *[0.6] * 2, *[1.0] * 2, *[0.0] * 2], key=float)
    assert found[2] == [1.0] and found[3] == [1.0] and found[5] == [1.0]
    assert sorted(map(str, found[4])) == sorted(["1.0", *["None"] * 4])
    assert asked[0].count() == 5 and "vector" not in asked[0].columns
