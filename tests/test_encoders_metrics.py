import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import clean, drift, joins, metrics, quality, similarity, stats
from ratingloom.operators.dictionary import build_dictionary, ids_of, map_ids, sequence_to_index
from ratingloom.operators.encoders import CategoryCounts, ItemEncoder, OneHot, ScaledPrice, Standardised
from ratingloom.operators.ranking import item_details, recent_purchases


def test_encoders(spark):
    schema = "item_id long, main_category string, categories array<string>, price string, s double"
    fit = spark.createDataFrame(
        [(1, "b", ["X", "y"], "$10", 1.0), (2, None, [], "none", 3.0), (3, "a", ["x"], "20.0", None)], schema
    )
    new = spark.createDataFrame([(9, "zzz", ["y", "Y", "q"], "15", 2.0), (8, None, None, None, None)], schema)
    one_hot = OneHot.fit(fit, "main_category")
    assert one_hot.levels == ("a", "b", None)
    rows = new.orderBy("item_id").select(one_hot().alias("x")).collect()
    assert [r["x"] for r in rows] == [[0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]
    counts = CategoryCounts.fit(fit, "categories")
    assert counts.terms == ("", "x", "y")
    assert [r["x"] for r in new.orderBy("item_id").select(counts().alias("x")).collect()] == [[1.0, 0.0, 0.0], [0.0, 0.0, 2.0]]
    price = ScaledPrice.fit(fit, "price")
    assert [r["x"] for r in new.orderBy("item_id").select(price().alias("x")).collect()] == [0.0, 0.75]
    scaler = Standardised.fit(fit, ["s"])
    mean, dev = 4 / 3, math.sqrt(((1 - 4 / 3) ** 2 + (3 - 4 / 3) ** 2 + (4 / 3) ** 2) / 3)
    got = new.where("item_id = 9").select(scaler().alias("x")).first()["x"][0]
    assert math.isclose(got, (2 - mean) / dev)
    constant = Standardised.fit(fit.withColumn("s", F.lit(5.0)), ["s"])
    assert fit.withColumn("s", F.lit(7.0)).select(constant().alias("x")).first()["x"] == [2.0]
    encoder = ItemEncoder.fit(fit, ["s"])
    assert encoder.width == 3 + 3 + 1 + 1
    vectors = [r["x"] for r in fit.select(encoder().alias("x")).collect()]
    for position in zip(*vectors):
        assert math.isclose(sum(position), 0.0, abs_tol=1e-9)
        assert math.isclose(sum(v * v for v in position) / 3, 1.0, abs_tol=1e-9)


def test_dictionary(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "item_id string")
    d = build_dictionary(df, "item_id", partitions=3)
    assert {r["item_id"]: r["idx"] for r in d.collect()} == {"a": 0, "b": 1, "c": 2}
    asked = spark.createDataFrame([("a",), ("zz",)], "item_id string")
    assert {r["item_id"]: r["n"] for r in map_ids(asked, d, "item_id", "n", 3).collect()} == {"a": 0, "zz": 3}
    back = ids_of(spark.createDataFrame([(1,), (-1,), (9,)], "n long"), d, "n", "item_id")
    assert {r["n"]: r["item_id"] for r in back.collect()} == {1: "b", -1: "unknown_item", 9: "unknown_item"}
    rows = spark.createDataFrame([(1, ["a", "zz", "c"]), (2, [])], "r long, s array<string>")
    seq = {r["r"]: r["item_sequence"] for r in sequence_to_index(rows, ["r"], "s", d, 3).collect()}
    assert seq == {1: [-1] * 7 + [0, 3, 2], 2: [-1] * 10}
    seq = {r["r"]: r["item_sequence"] for r in sequence_to_index(rows, ["r"], "s", d, 3, pad_unknown_when_empty=True).collect()}
    assert seq[2] == [-1] * 9 + [3]


def test_best_pairs_match_brute_force(spark):
    rng = random.Random(8)
    vectors = {n: [float(rng.randrange(-2, 3)) for _ in range(3)] for n in range(60)}  # many equal scores
    df = spark.createDataFrame(list(vectors.items()), "id long, vector array<double>")
    found = similarity.best_pairs(df, df, 5, skip_same=True, block_rows=7)
    got = {(r["query_id"], r["rank"]): (r["item_id"], r["score"]) for r in found.collect()}
    for q, v in vectors.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), n) for n, w in vectors.items() if n != q)[:5]
        assert [got[(q, k + 1)] for k in range(5)] == [(n, -s) for s, n in scores]
    ranges = {r["query_id"]: (r["n_scored"], r["low"], r["high"]) for r in similarity.score_all(df, df, 9).collect()}
    for q, v in vectors.items():
        scores = [sum(a * b for a, b in zip(v, w)) for w in vectors.values()]
        assert ranges[q] == (60, min(scores), max(scores))


def test_auroc(spark):
    def area(rows):
        return metrics.auroc(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()["auroc"]

    assert area([(1, 0.9), (0, 0.1)]) == 1.0
    assert area([(1, 0.5), (0, 0.5), (1, 0.5)]) == 0.5
    assert area([(1, 0.5), (1, 0.7)]) is None
    rng = random.Random(4)
    rows = [(rng.randrange(2), rng.randrange(10) / 10) for _ in range(80)]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    expected = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert math.isclose(area(rows), expected)


def test_pr_table(spark):
    rows = [(1, 0.9)] * 5 + [(0, 0.5)] * 15
    table = {r["top_perc"]: r for r in metrics.pr_table(spark.createDataFrame(rows, "y int, p double"), "y", "p").collect()}
    assert len(table) == 20
    assert (table[25]["count"], table[25]["precision"], table[25]["recall"]) == (5, 1.0, 1.0)
    assert (table[100]["count"], table[100]["precision"], table[100]["fp"]) == (20, 0.25, 15.0)


def test_ranking_metrics(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 12, 1), (2, 13, 2)], "user_id long, item_id long, rank int")
    truth = spark.createDataFrame([(1, 11, 3.0), (1, 99, 1.0), (3, 5, 4.0)], "user_id long, item_id long, rating double")
    ndcg = {r["k"]: r["ndcg"] for r in metrics.ndcg_at_k(recs, truth, 2).collect()}
    assert ndcg[1] == 0.0
    assert math.isclose(ndcg[2], (3 / math.log2(3)) / (3 + 1 / math.log2(3)) / 2)
    f = {r["k"]: r for r in metrics.fbeta_at_k(recs, truth, 2).collect()}
    assert (f[2]["precision"], f[2]["recall"], f[2]["fbeta"], f[2]["n_users"]) == (0.25, 0.25, 0.25, 2)


def test_personalization(spark):
    def value(lists, **kw):
        rows = [(u, i) for u, items in lists.items() for i in items]
        return metrics.personalization(spark.createDataFrame(rows, "user_id long, item_id long"), **kw).first()[0]

    assert value({1: [1, 2], 2: [1, 2], 3: [1, 2]}) == 0.0
    assert value({1: [1], 2: [2]}) == 1.0
    assert value({1: [1, 2]}) == 1.0
    lists = {u: random.Random(u).sample(range(30), 5) for u in range(40)}
    expected = [len(set(a) & set(b)) / len(set(a) | set(b)) for u, a in lists.items() for v, b in lists.items() if u < v]
    assert math.isclose(value(lists), 1 - sum(expected) / len(expected), rel_tol=1e-9)
    assert metrics.personalization(
        spark.createDataFrame([(u, i) for u, items in lists.items() for i in items], "user_id long, item_id long"), max_users=10
    ).first()["n_users"] == 10


def test_quality(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 9.0), (3, None)], "a long, b double")
    rules = [quality.Complete("a"), quality.InRange("b", 0.99, 5.01), quality.InRange("a", 0)]
    got = {r["rule"]: (r["outcome"], r["fail_count"], r["evaluated_rows"]) for r in quality.evaluate(df, rules).collect()}
    assert list(got.values()) == [("Failed", 1, 3), ("Failed", 1, 3), ("Passed", 0, 3)]
    with pytest.raises(clean.DataProblem, match="IsComplete"):
        quality.enforce(df, rules)
    assert quality.enforce(df, rules[2:]) is df


def test_drift(spark):
    rows = [(float(n % 10), "ab"[n % 2]) for n in range(100)]
    a = spark.createDataFrame(rows, "x double, c string")
    same = {r["column_name"]: r for r in drift.column_drift(a, a).collect()}
    assert same["x"]["drift_score"] == 0.0 and not same["c"]["detected"]
    b = spark.createDataFrame([(v + 100, "z") for v, _ in rows], "x double, c string")
    far = {r["column_name"]: r["drift_score"] for r in drift.column_drift(a, b).collect()}
    assert far == {"x": 1.0, "c": 1.0}
    assert drift.column_drift(a, a.withColumnRenamed("x", "y")) is None


def test_conform(spark):
    df = spark.createDataFrame([(None, "3", "2020-01-01", "x"), ("u", "bad", "2020-01-01", "1"), ("u", "4", "never", "1"), ("u", "4", "2020-01-01", "1")],
                               "user_id string, rating string, event_ts string, price string")
    got = clean.conform(df).collect()
    assert [(r["user_id"], r["item_id"], r["rating"], r["price"]) for r in got] == [("u", "None", 4.0, 1.0)]


def test_join_guards(spark):
    a = spark.createDataFrame([("val_x", 2.0), ("train_y", 1.0)], "metric string, value double")
    b = spark.createDataFrame([("val_x", 3.0)], "metric string, value double")
    row = joins.compare_metrics(a, b, ["val_x"]).first()
    assert (row["diff"], row["diff_perc"], row["position"]) == (1.0, 0.5, 1)
    with pytest.raises(clean.DataProblem):
        joins.compare_metrics(a, b.unionAll(b))
    rows = spark.createDataFrame([(1, 2)], "user_id long, item_id long")
    with pytest.raises(clean.DataProblem):
        joins.many_to_one(rows, rows.unionAll(rows).select("item_id"), ["item_id"])
    with pytest.raises(clean.DataProblem):
        clean.require_clean_keys(rows.unionAll(rows), ["user_id"])
    with pytest.raises(clean.DataProblem):
        joins.require_coverage(rows, rows.where("user_id > 1"), ["user_id"])


def test_item_details_fallbacks(spark):
    meta = spark.createDataFrame(
        [
            (1, "t", "M", ["a"], (["L"], ["H"])), (2, None, "M", [], ([], ["H"])), (3, "t", None, None, None),
        ],
        "item_id long, title string, main_category string, categories array<string>, images struct<large: array<string>, hi_res: array<string>>",
    )
    got = {r["item_id"]: (r["title"], r["image_url"], r["categories"]) for r in item_details(meta).collect()}
    assert got[1] == ("t", "L", ["a"])
    assert got[2] == ("No title", "H", ["M"])
    assert got[3][1].endswith("No+Image") and got[3][2] == ["Unknown"]
    history = spark.createDataFrame([(7, [(1, 10), (99, 20)])], "user_id long, hist array<struct<item_id: long, event_ts: long>>")
    shown = sorted((r["rank"], r["item_id"], r["title"]) for r in recent_purchases(history, meta).collect())
    assert shown == [(1, 99, "Unknown"), (2, 1, "t")]


def test_weighted_bce(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.0), (0, 1.0)], "y int, p double")
    loss = stats.weighted_bce(df, "y", "p", 2.0).first()["loss"]
    assert math.isclose(loss, (-2 * math.log(0.8) + 0 + 100) / 3)


def _brute(left, right, order, k, own, allowed):
    scores = np.round(left @ right.T, 9)
    scores[~allowed] = -np.inf
    scores[np.flatnonzero(own >= 0), own[own >= 0]] = -np.inf
    best = (np.lexsort((order, -row))[:k] for row in scores)
    return [(q, int(c)) for q, some in enumerate(best) for c in some if np.isfinite(scores[q, c])]


@pytest.mark.parametrize("case", ["plain", "copies", "all equal", "long", "whole numbers", "gap"])
@pytest.mark.parametrize("share", [0.05, 0.6, 1.0])
def test_best_rows_are_those_of_double_precision(case, share):
    rng = np.random.default_rng(7)
    left, right = rng.normal(size=(600, 12)), rng.normal(size=(9_000, 12))
    if case == "copies":
        right[rng.random(9_000) < 0.5] = right[0]
    if case == "all equal":
        left[:], right[:] = left[0], right[0]
    if case == "long":
        left, right = left * 1e20, right * 1e-12
    if case == "whole numbers":
        left, right = np.round(left), np.round(right)
    if case == "gap":
        right[5], left[3] = np.nan, np.inf
    order, own = rng.permutation(9_000), rng.integers(-1, 9_000, 600)
    starts = np.sort(np.append(rng.integers(0, 9_000, 30), [0, 9_000]))
    asked = rng.random((600, 31)) < share
    with np.errstate(invalid="ignore"):
        wanted = _brute(left, right, order, 11, own, np.isfinite(left @ right.T) & np.repeat(asked, np.diff(starts), axis=1))
        got = [(int(r), int(c)) for rows, columns, *_ in similarity.best_rows(left, right, order, 11, own, starts, asked)
               for r, c in zip(rows, columns)]
    assert got == wanted


def test_a_tile_hands_its_rows_on_strip_by_strip():
    """What leaves a tile is never held whole: no batch has more than a strip's rows."""
    vectors = np.random.default_rng(3).normal(size=(1_000, 4))
    tile = pa.table({"id": list(range(1_000)) * 2, "is_query": [True] * 1_000 + [False] * 1_000, "vector": list(vectors) * 2})
    sizes = [b.num_rows for b in similarity._best_in_tile(10, True)(iter(tile.to_batches()))]
    assert sum(sizes) == 10_000 and max(sizes) <= 10 * similarity.STRIP
