import numpy as np
import pytest

from ratingloom.llm.vector_search import Bounds, exact_scores, search_tile, top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    kept = [
        (i, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    result = []
    for n, (i, q) in enumerate(kept):
        if i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(q, x)), j) for m, (j, x) in enumerate(kept) if m != n]
            result += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(result)


def test_same_as_brute_force_with_ties_repeats_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.integers(-3, 4, 9) / 4]) for i in range(-100, 200)]
    rows += [rows[100], rows[100], (50, rows[3][1])]
    rows += [(None, [1.0] * 9), (300, None), (350, [None] * 9), (400, [float("nan")] * 9), (450, [float("inf")] * 9)]
    rows += [(500, []), (550, [1.0, 2.0]), (600, [100.0] * 20)]
    got = top_k(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_few_rows_and_none(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert top_k(spark.createDataFrame([(0, [1.0])], SCHEMA)).count() == 0
    rows = [(0, [1.0, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert sorted(map(tuple, top_k(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(4)
    q, x = rng.normal(0, 50, (20, 64)), rng.normal(0, 50, (30, 64))
    for segments in (1, 4, 16):
        upper = Bounds(q, segments).columns @ Bounds(x, segments).columns.T
        assert (upper >= q @ x.T - 1e-6).all()


@pytest.mark.parametrize("spread", [1, 40])
def test_tiles_with_known_thresholds_lose_nothing(spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 60, (4, 32))
    x = np.floor(centres[rng.integers(0, 4, 900)] + rng.normal(0, spread, (900, 32)))
    q, own = x[:12], np.full(12, -1)
    best, found = np.full(12, -np.inf), {i: [] for i in range(12)}
    for a in range(0, 900, 150):
        at, ids, scores = search_tile(q, np.arange(12) if a == 0 else own, x[a : a + 150], np.arange(a, a + 150), 5, best)
        for i, j, s in zip(at, ids, scores):
            found[i].append((-s, j))
        for i in found:
            if len(found[i]) >= 5:
                best[i] = max(best[i], -sorted(found[i])[4][0])
    for i in range(12):
        want = sorted((-int(x[j] @ q[i]), j) for j in range(900) if j != i)[:5]
        assert sorted(found[i])[:5] == want


def test_large_numbers_are_exact_or_refused():
    big = np.array([[2.0**30, 3.0]])
    assert exact_scores(big, np.array([[2.0**30, 1.0]])).tolist() == [2**60 + 3]
    with pytest.raises(OverflowError):
        exact_scores(big * 2.0**20, big)
