"""State in buckets: what a batch reads, replays, splits and cleaning."""

import pytest
from pyspark.sql import functions as F

from ratingloom.sources.keyed_state import KeyedState


def add(batch, known):
    """Sums per key."""
    new = batch.groupBy("k").agg(F.sum("v").alias("v"))
    if known is None:
        return new
    old = known.select("k", F.col("v").alias("old"))
    return new.join(old, "k", "left").select("k", (F.col("v") + F.coalesce("old", F.lit(0))).alias("v"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v long")


def values(state):
    return {r.k: r.v for r in state.current().collect()}


def test_a_batch_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    reads = []
    for users in (1000, 4000):
        state = KeyedState(spark, str(tmp_path / str(users)), ["k"], capacity=50)
        assert state.current() is None
        everyone = spark.range(users).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
        assert state.update(everyone, 0, add) == 0
        buckets = state.buckets()
        folder = F.regexp_extract(F.input_file_name(), "bucket=([^/]*)", 1)
        sizes = [r["count"] for r in state.current().groupBy(folder).count().collect()]
        assert len(buckets) >= users // 50 and sum(sizes) == users and max(sizes) <= 2 * 50
        reads.append(state.update(frame(spark, [(7, 5), (8, 1), (users + 1, 2)]), 1, add))
        found = values(state)
        assert len(found) == users + 1 and found[7] == 6 and found[9] == 1 and found[users + 1] == 2
    assert all(0 < n <= 3 * 100 for n in reads), reads  # three buckets, whatever the number of users


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), ["k"], capacity=10)
    state.update(frame(spark, [(i % 25, 1) for i in range(100)]), 0, add)
    for _ in range(2):
        state.update(frame(spark, [(1, 10), (99, 3)]), 1, add)
    assert values(state) == {i: 4 + 10 * (i == 1) for i in range(25)} | {99: 3}
    for _ in range(2):
        assert state.update(frame(spark, []), 2, add) == 0
    assert values(state)[1] == 14


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    path = tmp_path / "s"
    state = KeyedState(spark, str(path), ["k"])
    state.update(frame(spark, [(1, 1)]), 0, add)
    state.update(frame(spark, [(1, 5)]), 1, add)
    (path / "lists" / "batch=1" / "_SUCCESS").unlink()
    assert values(state) == {1: 1}
    state.update(frame(spark, [(1, 5)]), 1, add)
    assert values(state) == {1: 6}


@pytest.mark.parametrize("batches", [5])
def test_old_versions_are_removed(spark, tmp_path, batches):
    path = tmp_path / "s"
    state = KeyedState(spark, str(path), ["k"], capacity=4)
    for number in range(batches):
        state.update(frame(spark, [(i, 1) for i in range(number, number + 8)]), number, add)
    before = values(state)
    files = len(list(path.glob("rows/*/bucket=*")))
    state.clean()
    assert values(state) == before and len(list(path.glob("rows/*/bucket=*"))) < files
    assert len(state.batches()) == 2
    state.update(frame(spark, [(i, 1) for i in range(batches - 1, batches + 7)]), batches - 1, add)  # the last batch again
    assert values(state) == before
