"""Mean vectors in blocks of keys, and how an exact search is cut into tiles."""

import random

import pytest

from ratingloom.operators import models
from ratingloom.operators.models import mean_vectors
from ratingloom.operators.similarity import LARGE_BLOCK, tile_grid

# 2 has two vectors, 4 none, 5 a null in it, 6 and 7 another length, 8 nothing
VECTORS = [
    (1, [0.5, 1.0]), (2, [2.0, -1.0]), (2, [0.0, 3.0]), (3, [-4.0, 0.25]), (4, None), (5, [1.0, None]), (6, [1.0]),
    (7, [1.0, 2.0, 3.0]), (8, []), (None, [9.0, 9.0]),
]


def tables(spark):
    rng = random.Random(8)
    rows = [(u, rng.randrange(1, 11)) for u in range(3000) for _ in range(u % 5)] + [(None, 1), (None, 2), (7000, None), (7001, 4), (7002, 99)]
    rows += [(7003, i % 4) for i in range(600)]
    return spark.createDataFrame(rows, "user_id long, item_id long"), spark.createDataFrame(VECTORS, "item_id long, vector array<double>")


def found(df):
    return sorted(((r.user_id, [None if v is None else round(v, 9) for v in r.vector]) for r in df.collect()), key=str)


@pytest.mark.parametrize("summed", [1, 7, 32_768])
def test_means_in_blocks_are_those_of_a_join(spark, monkeypatch, summed):
    monkeypatch.setattr(models, "SUMMED_ROWS", summed if summed > 1 else 2)
    rows, vectors = tables(spark)
    in_blocks = mean_vectors(rows, "user_id", vectors, 2, few_keys=0)
    by_sums = mean_vectors(rows, "user_id", vectors, 2, few_keys=10**6)
    assert found(in_blocks) == found(by_sums) and in_blocks.dtypes == by_sums.dtypes


def test_heavy_keys_are_summed_where_they_lie(spark, split_everything):
    rows, vectors = tables(spark)
    assert found(mean_vectors(rows, "user_id", vectors, 2, few_keys=0)) == found(mean_vectors(rows, "user_id", vectors, 2))


def test_vectors_are_not_joined_to_the_rows_of_many_keys(spark):
    """Every row took its vector through a shuffle, as a partial sum that met no other."""
    rows, vectors = tables(spark)
    text = mean_vectors(rows, "user_id", vectors, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_tiles_are_as_large_as_a_task_can_hold(spark):
    """A search of 5,200,000 queries among 615,000 items sent 75 million vectors; blocks were half and a quarter as large."""
    queries, items = 5_200_000, 615_000
    rows, columns = tile_grid(queries, items, 12)
    assert -(-queries // rows) <= LARGE_BLOCK and -(-items // columns) <= LARGE_BLOCK
    assert queries * columns + items * rows < 30_000_000
    # fewer vectors are cut finer, so that every core has tiles
    rows, columns = tile_grid(615_000, 615_000, 12)
    assert rows * columns >= 48
    assert tile_grid(100, 10, 8) == (1, 1) and tile_grid(0, 0, 8) == (1, 1)
