"""The training table: what its rows copy is looked up at the end, and nothing wide is kept."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratingloom.operators.clean import DataProblem
from ratingloom.plans import training_set

STATS = ["n"]


@pytest.fixture
def tables(spark):
    ratings = [(u, (3 * u + n) % 11, float(n % 5), 1000 * (n % 4)) for u in range(9) for n in range(6)] + [(1, 3, 0.0, 0)] * 2
    positives = spark.createDataFrame(ratings, "user_id long, item_id long, rating double, ts_ms long")
    users = positives.select("user_id", "ts_ms").distinct().withColumn("seen", F.concat_ws(",", "user_id", "ts_ms"))
    stats = spark.createDataFrame([(i, 1000 * t, 10 * i + t) for i in range(10) for t in (0, 2)], "item_id long, ts_ms long, n long")
    metadata = spark.createDataFrame([(i, f"c{i}") for i in range(10)], "item_id long, main_category string")
    return positives, users, stats, metadata


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("ratio", [1, 2])
def test_looked_up_columns_are_the_copied_ones(tables, ratio):
    positives, users, stats, metadata = tables
    copied = training_set.training_table(positives.join(users, ["user_id", "ts_ms"]), stats, metadata, ["seen"], ratio, stat_columns=STATS)
    looked_up = training_set.training_table(positives, stats, metadata, ["seen"], ratio, stat_columns=STATS, users=users)
    found = rows_of(looked_up)
    assert found == rows_of(copied) and sum(found.values()) == (1 + ratio) * positives.count()
    assert all(r.seen == f"{r.user_id},{r.ts_ms}" for r in looked_up.collect())


def test_nothing_wide_is_written(tables, monkeypatch):
    """Positives with their user's columns, and then the whole table, were written and read again."""
    positives, users, stats, metadata = tables
    written = []
    monkeypatch.setattr(training_set, "durable", lambda df, keep=training_set.durable: (written.append(set(df.columns)), keep(df))[1])
    keys = ["user_id", "item_id", "rating", "ts_ms"]
    training_set.training_table(positives, stats, metadata, ["seen"], stat_columns=STATS, users=users, required=keys).count()
    assert written and all(columns == set(keys) for columns in written)


def test_required_columns_are_not_null(spark, tables):
    positives, users, stats, metadata = tables
    odd = positives.unionByName(spark.createDataFrame([(1, None, 2.0, 0)], positives.schema))
    with pytest.raises(DataProblem):
        training_set.training_table(odd, stats, metadata, ["seen"], stat_columns=STATS, users=users, required=["item_id"])
