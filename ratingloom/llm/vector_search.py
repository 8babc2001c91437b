"""Exact top-k search by inner product, with multi-resolution segment statistics.

Vectors are cut into segments; mean and deviation per segment bound a squared distance from below:
d^2 >= sum m * ((mean - mean')^2 + (dev - dev')^2), and so the inner product, (|q|^2 + |x|^2 - d^2) / 2, from
above. Resolutions go from one segment to many. What can't reach the k-th best score known so far is dropped at the
coarsest resolution that shows it; only survivors get their exact integer score, so no result is approximate.

Scale: rows are packed into blocks of bounded size. Every block of queries meets every block of candidates in one
tile, the work that a stated query set against all rows takes; k rows per query leave a tile. Equal vectors
give ties, all of which survive, at most one tile of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.registry import load, query
from ratingloom.session import durable

K = 5
EVERY = 50
SCALE = 256
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
RESOLUTIONS = (1, 4, 16)  # segments
EXACT = 2.0**53
FEW = 0.02  # share of open pairs from which on they are worked through one by one
PAIRS = 1 << 17

_BLOCK = "block long, n int, dim int, ids binary, data binary"


def _scaled(array: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their scaled vectors, shorter ones filled with zeros."""
    kept, vectors = [], []
    for i, vector in enumerate(array):
        if not vector.is_valid:
            continue
        flat = vector.values
        if flat.null_count:
            continue
        numbers = np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64)
        with np.errstate(over="ignore"):
            scaled = np.floor(numbers * scale)
        if np.isfinite(scaled).all():
            kept.append(i)
            vectors.append(scaled)
    width = max((len(v) for v in vectors), default=0)
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[: len(vector)] = vector
    return np.asarray(kept, dtype=np.int64), matrix


def _packed(block: list[int], ids: list[np.ndarray], data: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array(block, pa.int64()),
            "n": pa.array([len(d) for d in data], pa.int32()),
            "dim": pa.array([d.shape[1] for d in data], pa.int32()),
            "ids": pa.array([i.astype("<i8").tobytes() for i in ids], pa.binary()),
            "data": pa.array([d.astype("<f8").tobytes() for d in data], pa.binary()),
        }
    )


def pack(vectors: DataFrame, scale: int = SCALE, size: int = CANDIDATE_BLOCK) -> DataFrame:
    """Blocks of at most `size` vectors of (vec_id, embedding), as whole numbers floor(scale * x)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                kept, matrix = _scaled(part.column(1), scale)
                if len(kept):
                    ids = part.column(0).to_numpy(zero_copy_only=False)[kept]
                    yield _packed([number], [ids], [matrix])
                    number += 1

    rows = vectors.where("vec_id is not null").select("vec_id", "embedding")
    return durable(rows.mapInArrow(blocks, _BLOCK))


def _matrix(n: int, dim: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(n, dim)


def pack_queries(blocks: DataFrame, every: int = EVERY, size: int = QUERY_BLOCK) -> tuple[DataFrame, int]:
    """Blocks of query vectors (q, queries), and one more than the highest q.

    A query carries its own place (block, row) among the candidates.
    """
    single = "own_block long, own_row long, vec_id long, dim int, data binary"

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                matrix = _matrix(row["n"], row["dim"], row["data"])
                yield pa.RecordBatch.from_pydict(
                    {
                        "own_block": pa.array(np.full(len(at), row["block"])),
                        "own_row": pa.array(at.astype(np.int64)),
                        "vec_id": pa.array(ids[at]),
                        "dim": pa.array(np.full(len(at), row["dim"], np.int32)),
                        "data": pa.array([matrix[i].tobytes() for i in at], pa.binary()),
                    }
                )

    chosen = durable(blocks.mapInArrow(pick, single))
    count = max(1, -(-chosen.count() // size))
    slot = F.pmod(F.xxhash64("own_block", "own_row"), F.lit(count))
    members = F.collect_list(F.struct("own_block", "own_row", "vec_id", "dim", "data"))
    return chosen.groupBy(slot.alias("q")).agg(F.array_sort(members).alias("queries")), count


class Bounds:
    """Segment means and deviations at one resolution, weighted so that a dot product is the bound."""

    def __init__(self, matrix: np.ndarray, segments: int):
        parts = np.array_split(matrix, min(segments, max(1, matrix.shape[1])), axis=1)
        width = np.sqrt([max(1, p.shape[1]) for p in parts])
        means = np.stack([p.mean(axis=1) if p.shape[1] else np.zeros(len(p)) for p in parts], axis=1)
        devs = np.stack([p.std(axis=1) if p.shape[1] else np.zeros(len(p)) for p in parts], axis=1)
        self.columns = np.concatenate([means * width, devs * width], axis=1)


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows; raises if one does not fit a long."""
    if not left.size:
        return np.zeros(len(left), np.int64)
    if np.abs(left).max() * np.abs(right).max() * left.shape[1] < EXACT:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(left, right)]
    if any(not -(2**63) <= s < 2**63 for s in sums):
        raise OverflowError("a score does not fit a long")
    return np.asarray(sums, np.int64)


def _widened(matrix: np.ndarray, dim: int) -> np.ndarray:
    return matrix if matrix.shape[1] == dim else np.pad(matrix, ((0, 0), (0, dim - matrix.shape[1])))


def search_tile(
    queries: np.ndarray,
    own: np.ndarray,
    candidates: np.ndarray,
    ids: np.ndarray,
    k: int = K,
    known: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each query's k best candidates, best first; own[i] is a candidate row to leave out, or
    -1. Candidates that score below known[i], the k-th best of earlier tiles, may be missing.

    A resolution is worked out for the candidates that any query still has open, in one matrix product. When few
    pairs are left they go on one by one, else the exact scores are a matrix product, too.
    """
    dim = max(queries.shape[1], candidates.shape[1])
    queries, candidates = _widened(queries, dim), _widened(candidates, dim)
    best = np.full(len(queries), -np.inf) if known is None else known
    largest = max(1.0, np.abs(queries).max(initial=0)) * max(1.0, np.abs(candidates).max(initial=0))
    slack = 1e-9 * largest * max(1, dim)  # more than the rounding of a bound
    columns = np.arange(len(candidates))
    open_ = own[:, None] != columns[None, :]
    pairs = None
    for segments in RESOLUTIONS:
        if not np.isfinite(best).any():
            break  # nothing to measure bounds by
        left, right = Bounds(queries, segments).columns, Bounds(candidates[columns], segments).columns
        if pairs is None:
            open_ &= left @ right.T + slack >= best[:, None]
            used = open_.any(axis=0)
            columns, open_ = columns[used], open_[:, used]
            if open_.sum() <= FEW * open_.size:
                at_query, at = np.nonzero(open_)
                pairs = at_query, columns[at]
                columns = np.arange(len(candidates))
        else:
            q, x = pairs
            keep = np.einsum("ij,ij->i", left[q], right[x]) + slack >= best[q]
            pairs = q[keep], x[keep]
    if pairs is None and largest * dim < EXACT:
        scores = np.where(open_, queries @ candidates[columns].T, -np.inf)
        if scores.shape[1] > k:
            kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
            best = np.maximum(best, kth)
        q, at = np.nonzero((scores >= best[:, None]) & open_)
        x, s = columns[at], scores[q, at].astype(np.int64)
    else:
        if pairs is None:
            at_query, at = np.nonzero(open_)
            pairs = at_query, columns[at]
        q, x = pairs
        s = np.concatenate(
            [np.zeros(0, np.int64)]
            + [exact_scores(queries[q[i : i + PAIRS]], candidates[x[i : i + PAIRS]]) for i in range(0, len(q), PAIRS)]
        )
    order = np.lexsort((ids[x], -s, q))
    q, x, s = q[order], x[order], s[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], ids[x][rank < k], s[rank < k]


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score for queries whose id is divisible by `every`, against every other row.

    Rows with a null id, a null vector, null or non-finite components take no part, nor do those that leave the
    number range when scaled. Vectors of unequal length are compared as if filled with zeros. Repeated ids are
    rows of their own. Fewer than k candidates give as many rows; an empty table none.
    """
    blocks = pack(vectors, scale)
    queries, count = pack_queries(blocks, every)
    copies = blocks.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    tiles = copies.join(queries, "q")
    result = "own_block long, own_row long, query_id long, vec_id long, score long"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # by block of queries, the k-th best scores that this task has seen
        for batch in batches:
            for i in range(batch.num_rows):
                tile = batch.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(tile["ids"], "<i8")
                matrix = _matrix(tile["n"], tile["dim"], tile["data"])
                asked = tile["queries"]
                width = max(a["dim"] for a in asked)
                wanted = np.zeros((len(asked), width))
                for row, a in zip(wanted, asked):
                    row[: a["dim"]] = np.frombuffer(a["data"], "<f8")
                own = np.asarray([a["own_row"] if a["own_block"] == tile["block"] else -1 for a in asked])
                before = known.get(tile["q"], np.full(len(asked), -np.inf))
                at, found, scores = search_tile(wanted, own, matrix, ids, k, before)
                last = np.flatnonzero(np.arange(len(at)) - np.searchsorted(at, at) == k - 1)
                now = before.copy()
                now[at[last]] = np.maximum(now[at[last]], scores[last])
                known[tile["q"]] = now
                yield pa.RecordBatch.from_pydict(
                    {
                        "own_block": pa.array([asked[j]["own_block"] for j in at], pa.int64()),
                        "own_row": pa.array([asked[j]["own_row"] for j in at], pa.int64()),
                        "query_id": pa.array([asked[j]["vec_id"] for j in at], pa.int64()),
                        "vec_id": pa.array(found, pa.int64()),
                        "score": pa.array(scores, pa.int64()),
                    }
                )

    found = tiles.select("q", "block", "n", "dim", "ids", "data", "queries").mapInArrow(search, result)
    order = Window.partitionBy("own_block", "own_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


ORACLE = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS vec_row, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
    SELECT vec_id, vec_row, unnest(range(1, len(embedding) + 1)) AS i,
        unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS x FROM v),
scores AS (
    SELECT q.vec_id AS query_id, q.vec_row AS query_row, c.vec_id, c.vec_row, sum(q.x * c.x)::BIGINT AS score
    FROM parts q JOIN parts c ON q.i = c.i AND q.vec_row <> c.vec_row
    WHERE q.vec_id % 50 = 0
    GROUP BY ALL),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5
"""


@query("op6_top_k_search", ORACLE)
def op6_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best partners of every fiftieth vector among all vectors."""
    return top_k(load(spark, folder, "embeddings", "vec_id", "embedding"))
