"""Drift from kept counts against drift of the whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators.drift import column_counts, column_drift, drift_of_counts, keep_reference

SCHEMA = "name string, city string, amount double, seen timestamp"


def frame(spark, seed, n, shift=0.0):
    rng = random.Random(seed)
    rows = [
        (f"n{rng.randrange(400)}", rng.choice(["a", "b", None, "c" if shift else "a"]), rng.gauss(shift, 1) if rng.random() > 0.05 else None, rng.randrange(10**9))
        for _ in range(n)
    ]
    df = spark.createDataFrame(rows, "name string, city string, amount double, s long")
    return df.withColumn("seen", F.timestamp_seconds("s")).drop("s")


def scores(df):
    return {r.column_name: (r.test, r.drift_score, r.detected) for r in df.collect()}


@pytest.mark.parametrize("shift", [0.0, 0.7])
def test_parts_add_up_to_the_whole(spark, shift):
    reference = frame(spark, 1, 1500)
    parts = [frame(spark, seed, n, shift) for seed, n in ((2, 10), (3, 300), (4, 1))]
    counts = column_counts(parts[0]).unionByName(column_counts(parts[1])).unionByName(column_counts(parts[2]))
    assert counts.where("column_name = ''").agg(F.sum("n")).first()[0] == 311
    whole = scores(column_drift(reference, parts[0].unionByName(parts[1]).unionByName(parts[2])))
    kept = scores(drift_of_counts(keep_reference(reference), counts))
    assert set(kept) == set(whole) == {"name", "city", "amount", "seen"}
    for name, (test, score, detected) in whole.items():
        assert kept[name][0] == test and abs(kept[name][1] - score) < 1e-9 and kept[name][2] == detected
    assert whole["amount"][2] == (shift > 0)


def test_cuts_bound_what_is_kept_and_the_error(spark):
    reference, current = frame(spark, 5, 4000), frame(spark, 6, 500, 0.3)
    known = keep_reference(reference, cuts=100)
    sizes = {r.column_name: r["count"] for r in known.cuts.groupBy("column_name").count().collect()}
    assert all(n <= 100 for n in sizes.values()) and sizes["amount"] > 90
    exact, rough = scores(column_drift(reference, current)), scores(drift_of_counts(known, column_counts(current)))
    for name in ("amount", "seen"):
        assert abs(exact[name][1] - rough[name][1]) <= 1 / 100 + 1e-9
    assert abs(exact["name"][1] - rough["name"][1]) < 1e-9


def test_nothing_in_common(spark):
    a = spark.createDataFrame([("x",), (None,)], "v string")
    b = spark.createDataFrame([("y",)], "v string")
    assert scores(column_drift(a, b)) == {"v": ("js", 1.0, True)}
    assert scores(column_drift(a, a)) == {"v": ("js", 0.0, False)}
