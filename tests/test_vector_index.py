"""The inverted-list index against exact tiles."""

import numpy as np
import pytest

from ratingloom.operators import vector_index
from ratingloom.operators.similarity import best_pairs
from ratingloom.operators.vector_index import build_index, probes_for, recall, search


def frame(spark, rows, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in r]) for i, r in enumerate(rows)], "id long, vector array<double>")


def clustered(seed, n=2000, groups=40, size=16):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, size)) * 3
    rows = middle[rng.integers(0, groups, n)] + rng.normal(size=(n, size))
    return rows * rng.uniform(0.5, 2, (n, 1))  # of unequal length


def pairs(df):
    return sorted((r.query_id, r["rank"], r.item_id, round(r.score, 6)) for r in df.collect())


def test_few_lists_find_nearly_all_neighbours(spark):
    rows = clustered(1)
    items, queries = frame(spark, rows), frame(spark, clustered(1, 300) + 0.1, 10_000)
    index = build_index(items)
    assert index.lists() == 45 and index.table.count() == len(rows)
    probes = probes_for(index, queries, 10)
    assert probes < index.lists() / 2
    counted = recall(search(index, queries, 10, probes), best_pairs(queries, items, 10)).first()
    assert counted.n_queries == 300 and counted.n_exact == 3000 and counted.n_found >= 0.9 * 3000


@pytest.mark.parametrize("part, slice_", [(32_768, 65_536), (16, 50)])
def test_all_lists_are_exact_whatever_the_parts(spark, monkeypatch, part, slice_):
    monkeypatch.setattr(vector_index, "PART_ROWS", part)
    monkeypatch.setattr(vector_index, "QUERY_ROWS", slice_)
    items = frame(spark, clustered(2, 400))
    index = build_index(items, lists=6)
    assert pairs(search(index, items, 7, 6, skip_same=True)) == pairs(best_pairs(items, items, 7, skip_same=True))


def test_one_vector_that_holds_a_third_of_all_rows(spark):
    rows = clustered(3, 300)
    rows[::3] = rows[0]
    items = frame(spark, rows)
    index = build_index(items)
    found = search(index, items, 5, index.lists(), skip_same=True)
    assert pairs(found) == pairs(best_pairs(items, items, 5, skip_same=True))


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "id long, vector array<double>")
    one = frame(spark, [[1.0, 2.0]])
    assert search(build_index(none), one, 3, 2).count() == 0
    assert search(build_index(one), none, 3, 2).count() == 0
    assert pairs(search(build_index(one), one, 3, 1)) == [(0, 1, 0, 5.0)]
    assert search(build_index(one), one, 3, 1, skip_same=True).count() == 0
    zeros = frame(spark, [[0.0, 0.0], [0.0, 0.0], [1.0, 0.0]])
    assert search(build_index(zeros), zeros, 3, 3).count() == 9


def test_no_vector_goes_to_all_tiles(spark):
    """Stored vectors are read once per slice of their own list's queries, here one."""
    items = frame(spark, clustered(4, 500))
    index = build_index(items)
    assert index.table.count() == 500
    assert index.table.select("id").distinct().count() == 500
    assert vector_index._probed(index, items, 3).count() == 1500


def test_a_query_goes_once_to_a_cell_whatever_the_lists(spark):
    """All lists are looked into, and still a query is shuffled once per cell, not once per list."""
    items = frame(spark, clustered(5, 1200))
    index = build_index(items, lists=30)
    cells = vector_index._cells(index)
    assert len({(number, part) for number, part, _ in cells}) == len(cells) >= 30
    some = len({cell for *_, cell in cells})
    assert some < 10
    assert vector_index._probed(index, items, index.lists(), cells).count() == 1200 * some


@pytest.mark.parametrize("probes", [2, 9, 20])
def test_only_the_asked_lists_are_looked_into(spark, probes):
    rows, asking = clustered(6, 1500), clustered(6, 200) + 0.1
    index = build_index(frame(spark, rows), lists=24)
    found = {}
    for r in search(index, frame(spark, asking), 6, probes).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.item_id))
    home = {r.id: r["list"] for r in index.table.select("id", "list").collect()}
    lists = np.array([home[i] for i in range(len(rows))])
    for q, vector in enumerate(asking):
        near = np.argsort(-(index.centres[:, :-1] @ vector), kind="stable")[:probes]
        allowed = np.flatnonzero(np.isin(lists, near))
        best = allowed[np.lexsort((allowed, -np.round(rows[allowed] @ vector, 9)))][:6]
        assert sorted(found.get(q, [])) == [(i + 1, int(b)) for i, b in enumerate(best)]
