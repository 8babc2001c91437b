"""Inverted-list index over vectors: nearest vectors by scoring a few lists instead of all pairs.

Coarse centres are learned by k-means, each round one pass over a bounded sample in which every task sums its own
rows first. All vectors are then stored by the list of their centre. A query looks into the lists whose centres score
highest and scores their vectors exactly; how many lists that takes for a wished recall is measured on a bounded
sample of queries. A vector is shuffled once when the index is built and once per search and slice of the queries. Lists
lie side by side in cells of bounded size; a query is shuffled once per cell that holds any of its lists, with the bits of
these, so the work per query is that of its lists and what is shuffled does not grow with their number.

Inner products of vectors of unequal length are turned into angles: with one more component, sqrt(M^2 - |x|^2) for the
longest vector M, all stored vectors have the same length and the best inner product is the smallest angle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.ordered import top_per_key
from ratingloom.operators.similarity import ITEM_BLOCK, QUERY_BLOCK, _best_in_tile, best_pairs, blocks_of
from ratingloom.session import durable

MOST_LISTS = 16_384  # so centres and list sizes stay small enough for every task
SAMPLE_PER_LIST = 64  # rows that centres are learned from
ROUNDS = 8
PART_ROWS = 32_768  # vectors of a list in one part
CELL_ROWS = ITEM_BLOCK  # vectors scored by one task, or those of one part
QUERY_ROWS = QUERY_BLOCK  # queries of a cell scored by one task
CALIBRATION = 512  # queries that the number of lists to look into is measured on
RECALL = 0.95


@dataclass
class VectorIndex:
    """`centres` are of unit length, one row each. `table`: list, part, id, vector. `sizes`: list, parts."""

    centres: np.ndarray
    table: DataFrame
    sizes: DataFrame
    id_type: str

    def lists(self) -> int:
        return len(self.centres)


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """The rows with the component that brings all of them to one length."""
    rest = longest * longest - (rows * rows).sum(axis=1)
    return np.hstack([rows, np.sqrt(np.maximum(rest, 0.0))[:, None]])


def _assigned(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centre of highest score for each row, a strip at a time."""
    strip = max(1, 4_000_000 // len(centres))
    return np.concatenate(
        [np.argmax(rows[i : i + strip] @ centres.T, axis=1) for i in range(0, len(rows), strip)] or [np.zeros(0, np.int64)]
    )


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def learn_centres(vectors: DataFrame, lists: int, longest: float, rounds: int = ROUNDS) -> np.ndarray:
    """`lists` centres of (id, vector), learned from about SAMPLE_PER_LIST rows for each, those of least hash."""
    wanted = lists * SAMPLE_PER_LIST
    share = int(min(1.0, wanted / max(1, vectors.count())) * (1 << 30))
    sample = durable(vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).select("id", "vector"))
    start = sample.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(lists).select("vector").toPandas()
    if not len(start):
        return np.zeros((0, 1))
    centres = _unit(_lifted(np.array(start.vector.tolist(), np.float64), longest))
    spread = sample.repartition(min(256, max(sample.sparkSession.sparkContext.defaultParallelism, wanted // 100_000)))
    for _ in range(rounds):
        sums = _moved(spread, centres, longest).toPandas()  # one row per list at most
        moved = np.array(sums.total.tolist(), np.float64)
        centres = centres.copy()
        centres[sums["list"].to_numpy()] = _unit(moved)
    return centres


def _moved(sample: DataFrame, centres: np.ndarray, longest: float) -> DataFrame:
    """(list, total): sum of the rows nearest to each centre; every task sums its own rows before the shuffle."""
    shared = sample.sparkSession.sparkContext.broadcast(centres)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        totals, seen = np.zeros(known.shape), np.zeros(len(known), bool)
        for batch in batches:
            rows = _lifted(_rows(batch.column(1)), longest)
            near = _assigned(rows, known)
            np.add.at(totals, near, rows)
            seen[near] = True
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"list": pa.array(used, pa.int32()), "total": pa.array(list(totals[used]), pa.list_(pa.float64()))})

    def add(group: pa.Table) -> pa.Table:
        total = _rows(group.column("total").combine_chunks()).sum(axis=0)
        return pa.table({"list": group.column("list").slice(0, 1), "total": pa.array([total], pa.list_(pa.float64()))})

    schema = "list int, total array<double>"
    return sample.select("id", "vector").mapInArrow(partial, schema).groupBy("list").applyInArrow(add, schema)


def build_index(vectors: DataFrame, lists: int | None = None) -> VectorIndex:
    """Index of all rows of (id, vector array<double>); ids are unique, vectors of one length and without nulls.

    The number of lists is the square root of the number of rows, at most MOST_LISTS; a list of more than PART_ROWS
    vectors is cut into parts.
    """
    vectors = durable(vectors.select("id", "vector"))
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda t, v: t + v * v)).alias("m")).first()
    longest = float(np.sqrt(shape.m or 0.0))
    lists = min(MOST_LISTS, lists or max(1, round(shape.n**0.5)))
    centres = learn_centres(vectors, lists, longest)
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _assigned(_lifted(_rows(batch.column(1)), longest), shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), *batch.columns], names=["list", *batch.schema.names])

    id_type = vectors.schema["id"].dataType.simpleString()
    stored = durable(vectors.mapInArrow(assign, f"list int, id {id_type}, vector array<double>"))
    parts = F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int")
    sizes = durable(stored.groupBy("list").agg(parts.alias("parts")))
    cut = stored.join(F.broadcast(sizes), "list")  # MOST_LISTS rows at most
    table = cut.select("list", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "vector")
    return VectorIndex(centres, durable(table.repartition("list", "part")), sizes, id_type)


def _cells(index: VectorIndex) -> list[tuple[int, int, int]]:
    """(list, part, cell): the parts of all lists in order, put into cells of about CELL_ROWS vectors."""
    counted = index.table.groupBy("list", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("list", "part")
    parts = [tuple(r) for r in counted.collect()]  # as many as lists, and one per PART_ROWS vectors
    rows = sum(n for *_, n in parts)
    size = -(-rows // blocks_of(rows, CELL_ROWS, index.table.sparkSession)) if rows else 1
    found, cell, filled = [], 0, 0
    for number, part, n in parts:
        if filled and filled + n > size:
            cell, filled = cell + 1, 0
        filled += n
        found.append((number, part, cell))
    return found


def _probed(index: VectorIndex, queries: DataFrame, probes: int, cells: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """(id, vector, cell, lists): every query with the cells it looks into, and in each the bits of its lists, from the
    first list of the cell on. Without `cells` every list is one."""
    shared = queries.sparkSession.sparkContext.broadcast(index.centres[:, :-1])
    spans: dict[int, tuple[int, int]] = {}
    for number, _, cell in cells if cells is not None else [(n, 0, n) for n in range(index.lists())]:
        spans[cell] = (spans.get(cell, (number,))[0], number + 1)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        width = min(probes, len(centres))
        strip = max(1, 1_000_000 // max(1, len(centres)))
        for batch in batches:
            rows = _rows(batch.column(1))
            for at in range(0, len(rows), strip):
                some = rows[at : at + strip]
                asked = np.ones((len(some), len(centres)), bool)
                if width < len(centres):
                    best = np.argsort(-(some @ centres.T), axis=1, kind="stable")[:, :width]
                    asked[:] = False
                    np.put_along_axis(asked, best, True, axis=1)
                for cell, (low, high) in spans.items():
                    whose = np.flatnonzero(asked[:, low:high].any(axis=1))
                    if not len(whose):
                        continue
                    bits = np.packbits(asked[whose, low:high], axis=1)
                    taken = pa.array(whose + at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(taken), batch.column(1).take(taken),
                            pa.array(np.full(len(whose), cell, np.int32)), pa.array([b.tobytes() for b in bits], pa.binary()),
                        ],
                        names=["id", "vector", "cell", "lists"],
                    )

    kind = queries.schema["id"].dataType.simpleString()
    return queries.select("id", "vector").mapInArrow(look, f"id {kind}, vector array<double>, cell int, lists binary")


def search(index: VectorIndex, queries: DataFrame, k: int, probes: int, skip_same: bool = False) -> DataFrame:
    """Per query (id, vector) the k best vectors of the `probes` lists it looks into: query_id, item_id, score,
    raw_score, rank. Scores are exact; with as many probes as lists the result is, too.

    Every cell is scored by one task per QUERY_ROWS queries that look into it.
    """
    if not index.lists():
        return best_pairs(queries, index.table.select("id", "vector"), k, skip_same)
    spark = index.table.sparkSession
    cells = _cells(index)
    first: dict[int, int] = {}
    for number, _, cell in cells:
        first.setdefault(cell, number)
    counted = _probed(index, queries, probes, cells).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
    slices = {r["cell"]: blocks_of(r["n"], QUERY_ROWS, spark) for r in counted}  # one row per cell
    sliced = spark.createDataFrame([(c, n) for c, n in slices.items()], "cell int, slices int")
    home = spark.createDataFrame(
        [(number, part, cell, number - first[cell], slices[cell]) for number, part, cell in cells if cell in slices],
        "list int, part int, cell int, place int, slices int",
    )
    which = F.pmod(F.xxhash64("id", F.lit(7)), F.col("slices")).cast("int")
    nothing = F.lit(None)
    left = _probed(index, queries, probes, cells).join(F.broadcast(sliced), "cell").select(
        "cell", which.alias("slice"), "id", "vector", F.lit(True).alias("is_query"), nothing.cast("int").alias("list"), "lists"
    )
    right = index.table.join(F.broadcast(home), ["list", "part"]).select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "id", "vector",
        F.lit(False).alias("is_query"), F.col("place").alias("list"), nothing.cast("binary").alias("lists"),
    )
    schema = f"query_id {index.id_type}, item_id {index.id_type}, score double, raw_score double"
    # kept, as the tiles are the costly part: at most k rows per query and cell
    local = durable(left.unionByName(right).groupBy("cell", "slice").applyInArrow(_best_in_tile(k, skip_same), schema))
    return top_per_key(local, ["query_id"], [F.desc("score"), F.asc("item_id")], k, rank="rank")


def probes_for(index: VectorIndex, queries: DataFrame, k: int, recall: float = RECALL, skip_same: bool = False) -> int:
    """Lists to look into so that `recall` of the true k best are found, measured on at most CALIBRATION queries.

    Their true neighbours come from exact tiles over all vectors; what counts is the place of a neighbour's list among
    the lists as its query ranks them.
    """
    some = durable(queries.select("id", "vector").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(CALIBRATION))
    exact = best_pairs(some, index.table.select("id", "vector"), k, skip_same).select("query_id", "item_id")
    homes = exact.join(index.table.select(F.col("id").alias("item_id"), "list"), "item_id")
    pairs = homes.join(some.withColumnRenamed("id", "query_id"), "query_id").select("vector", "list")
    shared = queries.sparkSession.sparkContext.broadcast(index.centres[:, :-1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _rows(batch.column(0)) @ shared.value.T
            home = batch.column(1).to_numpy(zero_copy_only=False)
            own = score[np.arange(len(score)), home][:, None]
            tied = (score == own) & (np.arange(score.shape[1]) < home[:, None])
            yield pa.RecordBatch.from_pydict({"place": pa.array((score > own).sum(axis=1) + tied.sum(axis=1), pa.int64())})

    counts = pairs.mapInArrow(place, "place long").groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    found = counts.toPandas().sort_values("place")  # as many rows as lists at most
    if not len(found):
        return max(1, index.lists())
    share = found.n.cumsum() / found.n.sum()
    return int(found.place[share >= recall - 1e-12].iloc[0]) + 1


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(n_queries, n_exact, n_found): how many of the exact pairs (query_id, item_id) are among the found ones."""
    hit = found.select("query_id", "item_id", F.lit(1).alias("__hit"))
    return exact.select("query_id", "item_id").join(hit, ["query_id", "item_id"], "left").agg(
        F.count_distinct("query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_exact"), F.count("__hit").alias("n_found")
    )
