"""Order statistics against sorted lists."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import selection
from ratingloom.operators.clean import sample_rows


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_quantiles(spark, monkeypatch, accuracy):
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    rng = random.Random(1)
    # all different; a third of one value; few values; nulls; one value; none
    rows = [
        (rng.gauss(0, 1), 5.0 if i % 3 == 0 else rng.random() * 10, i % 4, None if i % 2 else i * 1.0, 7, None) for i in range(3001)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c int, d double, e int, f double")
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = selection.quantiles(df, df.columns, shares)
    for i, name in enumerate(df.columns[:5]):
        values = [r[i] for r in rows if r[i] is not None]
        assert np.allclose(found[name], np.quantile(values, shares), rtol=0, atol=1e-12), name
    assert found["f"] == [None] * 5


def test_few_values_are_inside_a_bracket(spark):
    df = spark.range(100_000).select(F.xxhash64("id").cast("double").alias("v"))
    everything = sorted(r.v for r in df.collect())
    assert selection.quantiles(df, ["v"], (0.5,))["v"][0] == (everything[49_999] + everything[50_000]) / 2
    assert selection.quantiles(df.limit(0), ["v"], (0.5,)) == {"v": [None]}


@pytest.mark.parametrize("n", [0, 1, 17, 299, 300, 1000])
def test_smallest_rows_with_ties(spark, n):
    df = spark.createDataFrame([(i, i % 5) for i in range(300)], "id long, k long")
    got = selection.smallest(df, n, F.col("k"), ["id"]).collect()
    assert sorted((r.k, r.id) for r in got) == sorted((i % 5, i) for i in range(300))[:n]


def test_sample_is_stable_and_of_the_wished_size(spark):
    df = spark.range(5000).withColumnRenamed("id", "user_id")
    runs = [sorted(r.user_id for r in sample_rows(df.repartition(p), 777, 3, ["user_id"]).collect()) for p in (1, 9)]
    assert runs[0] == runs[1] and len(set(runs[0])) == 777
    assert 2200 < np.mean(runs[0]) < 2800
