"""Scores of id pairs in tiles, overlap in one pass, and the size of a task."""

import math

import pytest

from ratingloom.operators.models import batch_score, in_tiles, pair_scores
from ratingloom.operators.stats import overlap_stats
from ratingloom.session import configure

PAIRS = [(1, 2, "a"), (2, 2, "b"), (3, 1, "c"), (1, 9, "d"), (None, 1, "e"), (4, 1, "f"), (5, 1, "g"), (6, 1, "h"), (1, 2, "a")]
# 2 has two vectors, 4 none, 5 a null in it, 6 another length
VECTORS = [(1, [0.5, 1.0]), (2, [2.0, -1.0]), (2, [0.0, 3.0]), (3, [-4.0, 0.25]), (4, None), (5, [1.0, None]), (6, [1.0]), (None, [1.0, 1.0])]


def brute():
    found = []
    for t, c, tag in PAIRS:
        for i, a in VECTORS:
            for j, b in VECTORS:
                if t is not None and (t, c) == (i, j):
                    known = a and b and len(a) == len(b) and None not in a + b
                    score = 1 / (1 + math.exp(-sum(x * y for x, y in zip(a, b)))) if known else None
                    found.append((t, c, tag, None if score is None else round(score, 9)))
    return sorted(found, key=str)


@pytest.fixture
def tables(spark):
    pairs = spark.createDataFrame(PAIRS, "target long, context long, tag string")
    return pairs, spark.createDataFrame(VECTORS, "item_id long, vector array<double>")


def rows_of(df):
    return sorted(((r.target, r.context, r.tag, None if r.score is None else round(r.score, 9)) for r in df.collect()), key=str)


def test_pairs_are_scored_as_joins_would(tables):
    assert rows_of(pair_scores(*tables)) == brute()


@pytest.mark.parametrize("tile_pairs", [1, 1000])
def test_tiles_of_any_size_give_the_same_rows(tables, tile_pairs):
    make = lambda part, left, right: part.append_column("n", left.is_valid().cast("int32"))
    found = in_tiles(*tables, make, "target long, context long, tag string, n int", tile_pairs=tile_pairs)
    assert sorted((r.target, r.context, r.tag) for r in found.collect()) == sorted(r[:3] for r in brute())


def test_plugged_scorer_sees_the_vectors(spark, tables):
    vectors = tables[1].where("size(vector) = 2 AND vector[1] IS NOT NULL")
    found = batch_score(tables[0], lambda f: [float(v[0]) for v in f["item_vector"]], keep=["target", "context", "tag"], vectors=vectors)
    assert sorted((r.target, r.context, r.score) for r in found.collect()) == sorted(
        (t, c, b[0]) for t, c, _ in PAIRS for i, a in VECTORS for j, b in VECTORS
        if t is not None and (t, c) == (i, j) and a and b and len(a) == len(b) == 2 and None not in a + b
    )


def test_vectors_are_not_joined_to_pairs(tables):
    text = pair_scores(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text


def test_overlap_reads_either_table_once(spark, tmp_path):
    schema = "user_id long, item_id long"
    spark.createDataFrame([(1, 7), (1, 7), (2, 7), (None, 8)], schema).write.parquet(f"{tmp_path}/train")
    spark.createDataFrame([(1, 8), (3, 9)], schema).write.parquet(f"{tmp_path}/val")
    train, val = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("train", "val"))
    found = overlap_stats(train, val)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    row = found.first()
    assert (row.train_rows, row.train_users, row.train_items, row.val_users, row.val_items) == (4, 3, 2, 2, 2)
    assert (row.known_user_share, row.known_item_share) == (0.5, 0.5)
    empty = overlap_stats(train.limit(0), val).first()
    assert (empty.train_rows, empty.train_users, empty.val_users) == (0, 0, 2)


def test_tasks_after_a_shuffle_read_sixteen_megabytes(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("16m", "16777216b")
