"""Nearest vectors and best-scoring pairs, exact, in bounded blocks.

Queries and items are hashed into blocks. Every (query block, item block) tile is one bounded group: a matrix
product, a strip of queries against a chunk of items at a time, and a local top-k inside an Arrow function. A tile hands
on at most k rows per query, strip by strip, so the full set of pairs never exists; a second top-k per query merges the
tiles. Vectors are unique per id, so no tile grows with a hot key. A vector is shuffled once per block of the other side,
which is why blocks are large when there are many vectors and only cut finer to give every core some tiles.

The product is taken in single precision, whose error is bounded by the lengths of the two vectors. Only pairs that may
reach the k-th best score found so far, error included, are scored again in double precision, and these scores decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.ordered import top_per_key

QUERY_BLOCK = 65_536
ITEM_BLOCK = 131_072
LARGE_BLOCK = 262_144  # of either side of an exact search; a task holds one of each
TILES_PER_CORE = 4
LEAST_ROWS = 256
STRIP_SCORES = 4_000_000  # scores of a tile held at a time
STRIP = 256  # queries that look for their best items at a time
CHUNK = 8_192  # items they are scored against at a time
FIRST_CHUNK = 2_048
EXACT_PAIRS = 16_384  # pairs scored in double precision at a time
LARGEST = 1e18  # length of a vector up to which single precision can't overflow
SCORE_DIGITS = 9  # scores are compared after rounding, so that equal vectors tie and the id decides


def tile_grid(queries: int, items: int, cores: int) -> tuple[int, int]:
    """Number of blocks of either side: as few as a task can hold, as a vector is shuffled once per block of the other
    side, but cut finer, down to QUERY_BLOCK and ITEM_BLOCK, while there are less than TILES_PER_CORE tiles per core."""
    blocks = [max(1, -(-n // LARGE_BLOCK)) for n in (queries, items)]
    most = [max(1, -(-n // least)) for n, least in ((queries, QUERY_BLOCK), (items, ITEM_BLOCK))]
    while blocks[0] * blocks[1] < TILES_PER_CORE * cores and blocks != most:
        sizes = [n / b if b < m else 0 for n, b, m in zip((queries, items), blocks, most)]
        blocks[sizes.index(max(sizes))] += 1
    return blocks[0], blocks[1]


def _blocks(queries: DataFrame, items: DataFrame, block_rows: int | None) -> tuple[int, int]:
    """Number of blocks of both sides."""
    numbers = queries.count(), items.count()
    if block_rows:
        return tuple(max(1, -(-n // block_rows)) for n in numbers)
    spark = queries.sparkSession
    grid = tile_grid(*numbers, spark.sparkContext.defaultParallelism)
    # a small side is cut for the cores as well
    return tuple(max(g, blocks_of(n, LARGE_BLOCK, spark)) for g, n in zip(grid, numbers))


def blocks_of(n: int, largest: int, spark: SparkSession) -> int:
    """Number of blocks of n rows: of bounded size, and enough to give every core a tile."""
    side = int(spark.sparkContext.defaultParallelism**0.5) + 1
    return max(-(-n // largest), min(side, n // LEAST_ROWS), 1)


def _tiles(queries: DataFrame, items: DataFrame, block_rows: int | None) -> DataFrame:
    """(id, vector) of both sides, once per tile of its block row or column."""
    q_blocks, i_blocks = _blocks(queries, items, block_rows)

    def placed(df: DataFrame, is_query: bool) -> DataFrame:
        own, other = (q_blocks, i_blocks) if is_query else (i_blocks, q_blocks)
        names = ("__qb", "__ib") if is_query else ("__ib", "__qb")
        return df.select(
            "id",
            "vector",
            F.lit(is_query).alias("is_query"),
            F.pmod(F.xxhash64("id"), F.lit(own)).cast("int").alias(names[0]),
            F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1]),
        )

    return placed(queries, True).unionByName(placed(items, False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _sides(tile: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Queries, and items in id order."""
    is_query = tile.column("is_query")
    return tile.filter(is_query), tile.filter(pc.invert(is_query)).sort_by("id")


def _strips(queries: pa.Table, items: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(first query row, scores of some query rows against all items)."""
    if not queries.num_rows or not items.num_rows:
        return
    left, right = _matrix(queries.column("vector")), _matrix(items.column("vector")).T
    height = max(1, STRIP_SCORES // items.num_rows)
    for first in range(0, len(left), height):
        yield first, left[first : first + height] @ right


def _first_k(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best finite scores per row, equal scores by column."""
    keep = np.isfinite(scores)
    if scores.shape[1] > k:
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        keep &= scores >= edge
    rows, columns = np.nonzero(keep)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    starts = np.searchsorted(rows, np.arange(len(scores)))
    best = np.arange(len(rows)) - starts[rows] < k
    return rows[best], columns[best]


def _searched_type(left: np.ndarray, right: np.ndarray) -> tuple[type, np.ndarray]:
    """The precision to look for candidates in, and per query how far such a score may lie from the exact one."""
    with np.errstate(over="ignore", invalid="ignore"):
        own, other = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
        longest = other.max(initial=0.0)
        single = bool(own.max(initial=0.0) < LARGEST and longest < LARGEST)  # false for NaN, too
        margin = 1.01 * (left.shape[1] + 8) * 2.0 ** (-24 if single else -53) * own * longest
    return np.float32 if single else np.float64, np.where(np.isfinite(margin), margin, np.inf)


def _exact(left: np.ndarray, right: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Scores of single pairs in double precision."""
    found = np.empty(len(rows))
    for at in range(0, len(rows), EXACT_PAIRS):
        some = slice(at, at + EXACT_PAIRS)
        found[some] = np.einsum("ij,ij->i", left[rows[some]], right[columns[some]])
    return found


def _places(flags: np.ndarray) -> np.ndarray:
    """Where the few true ones of many flags stand."""
    even = len(flags) // 8 * 8
    words = np.flatnonzero(flags[:even].view(np.uint64))
    word, bit = np.nonzero(flags[:even].reshape(-1, 8)[words])
    return np.concatenate([words[word] * 8 + bit, even + np.flatnonzero(flags[even:])])


class _Strip:
    """The best items that a few queries have found so far."""

    def __init__(self, left: np.ndarray, searched: np.ndarray, margin: np.ndarray, k: int, space: tuple) -> None:
        self.left, self.searched, self.margin, self.k, self.space = left, searched, margin, k, space
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending, self.floor = 0, np.full(len(left), -np.inf)

    def look(self, right: np.ndarray, chunk: np.ndarray, first: int, order: np.ndarray, rows: np.ndarray | None, barred) -> None:
        """Score a chunk of items, the rows of `right` from `first` on; `rows` are the queries that ask for it, and
        barred(rows) says which of its pairs don't count."""
        every = rows is None
        rows = np.arange(len(self.left)) if every else rows
        # the same memory for every chunk: new pages cost more than the product
        scores, above = (part[: len(rows) * len(chunk)].reshape(len(rows), -1) for part in self.space)
        with np.errstate(over="ignore", invalid="ignore"):
            np.matmul(self.searched if every else self.searched[rows], chunk.T, out=scores)
        if scores.dtype == np.float64:
            scores[~np.isfinite(scores)] = -np.inf
        barred(scores, rows)
        width, k = scores.shape[1], self.k
        new = np.flatnonzero(np.isneginf(self.floor[rows]))
        if len(new) and width > k:
            edge = np.partition(scores[new], width - k, axis=1)[:, width - k].astype(float)
            self.floor[rows[new]] = edge - 2 * self.margin[rows[new]] - 2 * 10.0**-SCORE_DIGITS
        least = np.finfo(scores.dtype)
        floor = np.maximum(np.nextafter(self.floor[rows].astype(scores.dtype), -np.inf, dtype=scores.dtype), least.min)
        hits = _places(np.greater_equal(scores, floor[:, None], out=above).reshape(-1))
        if len(hits) * 8 <= scores.size:
            at, columns = hits // width, hits % width + first
            at = rows[at]
            raw = _exact(self.left, right, at, columns)
        else:
            # hardly anything is ruled out, as among many equal vectors
            places = np.argsort(order[first : first + width], kind="stable")
            with np.errstate(over="ignore", invalid="ignore"):
                whole = self.left[rows] @ right[first + places].T
            whole[np.isneginf(scores[:, places])] = -np.inf
            at, columns = _first_k(np.round(whole, SCORE_DIGITS), k)
            at, columns, raw = rows[at], places[columns] + first, whole[at, columns]
        self.parts.append((at, columns, raw))
        self.pending += len(at)
        if self.pending > 2 * k * len(self.left):
            self.settle(order)

    def settle(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, rounded score, score) of the k best of each query, equal scores by the place of the item's id."""
        nothing = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        rows, columns, raw = (np.concatenate(part) for part in zip(nothing, *self.parts))
        fine = np.isfinite(raw)
        rows, columns, raw = rows[fine], columns[fine], raw[fine]
        scores = np.round(raw, SCORE_DIGITS)
        by = np.lexsort((order[columns], -scores, rows))
        starts = np.searchsorted(rows[by], np.arange(len(self.left)))
        place = np.arange(len(by)) - starts[rows[by]]
        by, place = by[place < self.k], place[place < self.k]
        rows, columns, raw, scores = rows[by], columns[by], raw[by], scores[by]
        last = place == self.k - 1
        floor = scores[last] - self.margin[rows[last]] - 2 * 10.0**-SCORE_DIGITS
        self.floor[rows[last]] = np.maximum(self.floor[rows[last]], floor)
        self.parts, self.pending = [(rows, columns, raw)], len(rows)
        return rows, columns, scores, raw


def _pieces(starts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first item, last item + 1, first list, last list + 1): items in chunks of bounded size, made of whole lists or of
    a part of one. `starts` are the lists' first items and the number of all."""
    found, chunk, at = [], FIRST_CHUNK, 0
    while at < len(starts) - 1:
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + chunk, side="right")) - 1)
        for first in range(int(starts[at]), int(starts[end]), chunk):
            found.append((first, min(first + chunk, int(starts[end])), at, end))
        at, chunk = end, CHUNK
    return found


def best_rows(
    left: np.ndarray, right: np.ndarray, order: np.ndarray, k: int, own: np.ndarray | None = None,
    starts: np.ndarray | None = None, asked: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(query, item, rounded score, score) of the k best rows of `right` for every row of `left`, a strip at a time.

    `order` says how the ids of the items sort; `own` is the item of each query that doesn't count, or -1. With `starts`,
    the first item of each list, and `asked`, which lists each query asks for, other lists are not looked into.
    """
    if not len(left) or not len(right):
        return
    kind, margin = _searched_type(left, right)
    searched, chunks = left.astype(kind, copy=False), right.astype(kind, copy=False)
    if asked is None:
        starts = np.unique(np.append(np.arange(FIRST_CHUNK, len(right), CHUNK), [0, len(right)]))
    pieces, sizes = _pieces(starts), np.diff(starts)
    most = min(STRIP, len(left)) * min(CHUNK, len(right))
    space = np.empty(most, kind), np.empty(most, bool)

    for first in range(0, len(left), STRIP):
        some = slice(first, first + STRIP)
        strip = _Strip(left[some], searched[some], margin[some], k, space)
        mine = None if own is None else own[some]
        wish = None if asked is None else asked[some]

        def look(a: int, b: int, rows: np.ndarray | None, mask: np.ndarray | None = None) -> None:
            def barred(scores: np.ndarray, of: np.ndarray) -> None:
                if mine is not None:
                    at = np.flatnonzero((mine[of] >= a) & (mine[of] < b))
                    scores[at, mine[of][at] - a] = -np.inf
                if mask is not None:
                    scores[~mask] = -np.inf

            strip.look(right, chunks[a:b], a, order, rows, barred)

        for a, b, low, high in pieces:
            if wish is None or wish[:, low:high].all():
                look(a, b, None)
            elif (wish[:, low:high] @ sizes[low:high]).sum() > 0.5 * len(wish) * sizes[low:high].sum() and high - low > 1:
                look(a, b, None, np.repeat(wish[:, low:high], sizes[low:high], axis=1))
            else:
                for number in range(low, high):
                    rows = np.flatnonzero(wish[:, number])
                    if len(rows):
                        look(max(a, int(starts[number])), min(b, int(starts[number + 1])), rows)
        rows, columns, scores, raw = strip.settle(order)
        yield rows + first, columns, scores, raw


def _filled(parts: list[pa.Array], rows: int) -> np.ndarray:
    """One matrix of the vectors; its parts are let go one by one."""
    whole, at = None, 0
    parts.reverse()
    while parts:
        some = _matrix(pa.chunked_array([parts.pop()]))
        whole = np.empty((rows, some.shape[1])) if whole is None else whole
        whole[at : at + len(some)] = some
        at += len(some)
    return np.empty((0, 1)) if whole is None else whole


def _best_in_tile(k: int, skip_same: bool):
    """The k best items of every query of a tile: rows of is_query, id and vector. Items may have `list`, a number, and
    queries `lists`, the bits of the numbers they ask for."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "vector", "list", "lists")
        kept: dict[bool, dict[str, list]] = {side: {n: [] for n in names} for side in (True, False)}
        for batch in batches:
            is_query = batch.column(batch.schema.names.index("is_query"))
            for side in (True, False):
                part = batch.filter(is_query if side else pc.invert(is_query))
                for name in names:
                    if part.num_rows and name in part.schema.names:
                        kept[side][name].append(part.column(part.schema.names.index(name)))
        if not all(kept[side]["id"] for side in kept):
            return
        q_ids, i_ids = (pa.chunked_array(kept[side]["id"]).combine_chunks() for side in (True, False))
        left, right = _filled(kept[True]["vector"], len(q_ids)), _filled(kept[False]["vector"], len(i_ids))
        starts = asked = None
        if kept[False]["list"]:
            number = pa.chunked_array(kept[False]["list"]).to_numpy()
            by = np.argsort(number, kind="stable")
            right, i_ids, number = right[by], i_ids.take(pa.array(by)), number[by]
            bits = np.frombuffer(b"".join(pa.chunked_array(kept[True]["lists"]).to_pylist()), np.uint8)
            asked = np.unpackbits(bits.reshape(len(q_ids), -1), axis=1).astype(bool)
            starts = np.searchsorted(number, np.arange(asked.shape[1] + 1))
            asked = None if asked[:, number[0] : number[-1] + 1].all() else asked
        order = np.empty(len(i_ids), np.int64)
        order[pc.array_sort_indices(i_ids).to_numpy()] = np.arange(len(i_ids))
        own = pc.fill_null(pc.index_in(q_ids, i_ids), -1).to_numpy() if skip_same else None
        for rows, columns, scores, raw in best_rows(left, right, order, k, own, starts, asked):
            yield pa.RecordBatch.from_arrays(
                [q_ids.take(pa.array(rows)), i_ids.take(pa.array(columns)), pa.array(scores), pa.array(raw)],
                names=["query_id", "item_id", "score", "raw_score"],
            )

    return best


def best_pairs(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    skip_same: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Per query the k items of highest dot product: query_id, item_id, score, raw_score, rank.

    Both sides hold (id, vector array<double>) with unique ids and one vector length. `skip_same` leaves the
    item with the query's own id out. On unit vectors the score is the cosine. Ranks go by the rounded score,
    then by the lower id; `raw_score` is not rounded.
    """
    grid = _tiles(queries, items, block_rows)
    id_type = grid.schema["id"].dataType.simpleString()
    local = grid.groupBy("__qb", "__ib").applyInArrow(
        _best_in_tile(k, skip_same), f"query_id {id_type}, item_id {id_type}, score double, raw_score double"
    )
    return top_per_key(local, ["query_id"], [F.desc("score"), F.asc("item_id")], k, rank="rank")


def _score_range(tile: pa.Table) -> pa.Table:
    queries, items = _sides(tile)
    found = [(np.empty(0), np.empty(0))]
    for _, scores in _strips(queries, items):
        found.append((scores.min(axis=1), scores.max(axis=1)))
    low, high = (np.concatenate(part) for part in zip(*found))
    return pa.table({
        "query_id": queries.column("id").slice(0, len(low)),
        "n": pa.array(np.full(len(low), items.num_rows, np.int64)),
        "low": pa.array(low),
        "high": pa.array(high),
    })


def score_all(queries: DataFrame, items: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Score every (query, item) pair; per query the number of pairs and the lowest and highest score.

    The pairs themselves stay inside the tiles.
    """
    grid = _tiles(queries, items, block_rows)
    id_type = grid.schema["id"].dataType.simpleString()
    local = grid.groupBy("__qb", "__ib").applyInArrow(
        _score_range, f"query_id {id_type}, n long, low double, high double"
    )
    return local.groupBy("query_id").agg(
        F.sum("n").alias("n_scored"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def as_vectors(df: DataFrame, id_column: str, vector: Column | str) -> DataFrame:
    """The (id, vector) shape the functions above take."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return df.select(F.col(id_column).alias("id"), column.alias("vector"))
