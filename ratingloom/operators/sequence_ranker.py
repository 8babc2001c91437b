"""Ranker over item features and the user's history, place by place, fitted on sparse rows.

A row's features are the entries of its item, the likeness of the item to each of the last items of the user, and the
age of each of these. Positions are hashed into WIDTH places, so vocabularies have no limit and the model has a fixed
size. The weighted logistic loss is brought down by a limited-memory quasi-Newton method: each step broadcasts the
model, every task sums the slope of its own rows, and only those sums are shuffled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.times import HISTORY_LENGTH, age_bucket
from ratingloom.functions.vectors import unit
from ratingloom.operators.models import in_tiles
from ratingloom.operators.skew import BROADCAST_CUTS
from ratingloom.session import durable

WIDTH = 1 << 18
PENALTY = 1.0  # on half the squared coefficients, against the summed loss
STEPS = 30
MEMORY = 8
ENOUGH = 1e-5  # a step that lowers the loss by less than this part ends the search


def place(kind: str, *key: Column) -> Column:
    """The place of a feature in the model."""
    return F.pmod(F.xxhash64(F.lit(kind), *key), F.lit(WIDTH)).cast("int")


def sparse_rows(rows: DataFrame, entries: DataFrame, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`keep`, places array<int>, values array<double> of every row of `rows` (item_id, ts_ms, hist, ...).

    `entries` (item_id, pos, value) describe items; `vectors` (item_id, vector) tell how alike two items are, unknown
    ones being like none. `hist` lists (item_id, event_ts), oldest first, of bounded length. Places count from the
    newest one. Rows that are numbered already, in __row, and kept are not written again.
    """
    numbered = rows if "__row" in rows.columns else durable(rows.withColumn("__row", F.monotonically_increasing_id()))
    described = entries.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct(place("item", F.col("pos")).alias("place"), F.col("value").alias("value")))).alias("__item")
    )
    ids = durable(vectors.where(F.col("item_id").isNotNull()).select("item_id").distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_CUTS else ids
    back = F.size("hist") - F.col("__at")
    age = age_bucket(F.floor(F.col("ts_ms") / 1000) - F.unix_seconds("__event"))
    # only what two vectors are known of is compared, and vectors are not joined to it: most have none, and all are wide
    visits = numbered.select("__row", "item_id", "ts_ms", "hist").join(ids, "item_id", "left_semi").select(
        "__row", "item_id", "ts_ms", "hist", F.posexplode("hist").alias("__at", "__h")
    ).select(
        "__row", "item_id", F.col("__h.item_id").alias("__seen"), back.alias("__back"), "ts_ms", F.col("__h.event_ts").alias("__event")
    ).where(F.col("__back") <= HISTORY_LENGTH)
    pairs = visits.join(ids.withColumnRenamed("item_id", "__seen"), "__seen", "left_semi").select(
        F.col("__row").alias("__number"), "__back", age.alias("__age"), "__seen", "item_id"
    )
    known = vectors.select("item_id", unit(F.col("vector")).alias("vector"))
    compared = in_tiles(pairs, known, _likeness, "__number long, __back int, __age int, __like double", "__seen", "item_id")
    like = F.struct(place("like", F.col("__back")).alias("place"), F.col("__like").alias("value"))
    by_age = F.struct(place("age", F.col("__age")).alias("place"), F.col("__like").alias("value"))
    history = compared.groupBy(F.col("__number").alias("__row")).agg(F.sort_array(F.flatten(F.collect_list(F.array(like, by_age)))).alias("__history"))
    carried = numbered.select("__row", "item_id", F.struct(*keep).alias("__kept"))
    # the entries of an item are as wide as all the rest, so they come last
    whole = carried.join(history, "__row", "left").drop("__row").join(described, "item_id", "left").drop("item_id")
    none = F.array().cast("array<struct<place:int,value:double>>")
    one = F.array(F.struct(place("one").alias("place"), F.lit(1.0).alias("value")))
    both = F.concat(F.coalesce("__item", none), F.coalesce("__history", none), one)
    return whole.withColumn("__all", both).select(
        "__kept.*", F.col("__all.place").alias("places"), F.col("__all.value").alias("values")
    )


def _likeness(part: pa.Table, left: pa.Array, right: pa.Array) -> pa.Table:
    """Product of the two vectors of each pair; none where one is unknown, or lacks a place of the other."""
    sides = [(side.flatten(), side.value_lengths()) for side in (left, right)]
    lengths = pc.unique(pa.chunked_array([n for _, n in sides]))
    if left.null_count or right.null_count or len(lengths) != 1 or any(values.null_count for values, _ in sides):
        found = []
        for a, b in zip(left.to_pylist(), right.to_pylist()):
            fits = a is not None and b is not None and len(a) == len(b) and None not in a and None not in b
            found.append(sum((x * y for x, y in zip(a, b)), 0.0) if fits else None)
    else:
        a, b = (values.to_numpy().reshape(len(part), -1) for values, _ in sides)
        found = np.zeros(len(part))
        for at in range(a.shape[1]):  # in this order, as anywhere else
            found += a[:, at] * b[:, at]
    return part.select(["__number", "__back", "__age"]).append_column("__like", pa.array(found, pa.float64()))


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, its place, its value)."""
    places = batch.column(batch.schema.names.index("places"))
    values = batch.column(batch.schema.names.index("values"))
    owner = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
    return owner, places.flatten().to_numpy(), values.flatten().to_numpy()


def _margins(batch: pa.RecordBatch, model: np.ndarray) -> np.ndarray:
    owner, places, values = _flat(batch)
    return np.bincount(owner, values * model[places], minlength=batch.num_rows)


def _slope(rows: DataFrame, model: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, slope and a bound on the curvature in each place, from one pass over (places, values, y, w)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        loss, slope, curve = 0.0, np.zeros(WIDTH), np.zeros(WIDTH)
        for batch in batches:
            owner, places, values = _flat(batch)
            y, w = (batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            margin = _margins(batch, known)
            loss += float((w * (np.logaddexp(0, margin) - y * margin)).sum())
            off = w * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y)
            slope += np.bincount(places, off[owner] * values, minlength=WIDTH)
            curve += np.bincount(places, (w / 4)[owner] * values * values, minlength=WIDTH)
        used = np.flatnonzero(curve)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(slope[used], loss)), pa.array(np.append(curve[used], 0.0))],
            names=["place", "slope", "curve"],
        )

    sums = rows.mapInArrow(partial, "place int, slope double, curve double").groupBy("place").agg(
        F.sum("slope").alias("slope"), F.sum("curve").alias("curve")
    )
    found = sums.toPandas()  # WIDTH + 1 rows at most
    shared.unpersist()
    slope, curve = np.zeros(WIDTH), np.zeros(WIDTH)
    places = found[found.place >= 0]
    slope[places.place.to_numpy()], curve[places.place.to_numpy()] = places.slope.to_numpy(), places.curve.to_numpy()
    loss = float(found.loc[found.place < 0, "slope"].sum()) + PENALTY / 2 * float(model @ model)
    return loss, slope + PENALTY * model, curve + PENALTY


def _direction(slope: np.ndarray, curve: np.ndarray, steps: deque) -> np.ndarray:
    """Two-loop recursion over the remembered (step, change of slope), with the curvature bound as first guess."""
    way, shares = slope.copy(), []
    for s, y in reversed(steps):
        share = (s @ way) / (s @ y)
        shares.append(share)
        way -= share * y
    way /= curve
    for (s, y), share in zip(steps, reversed(shares)):
        way += (share - (y @ way) / (s @ y)) * s
    return -way


def fit(rows: DataFrame, label: str, positive_weight: float, steps: int = STEPS) -> np.ndarray:
    """Coefficients from the rows (places, values, label); positives weigh `positive_weight`."""
    positive = F.col(label) > 0
    table = rows.select(
        "places", "values", positive.cast("double").alias("y"), F.when(positive, positive_weight).otherwise(1.0).alias("w")
    )
    model = np.zeros(WIDTH)
    loss, slope, curve = _slope(table, model)
    remembered: deque = deque(maxlen=MEMORY)
    for _ in range(steps):
        way, size = _direction(slope, curve, remembered), 1.0
        down = float(way @ slope)
        while True:
            tried = model + size * way
            found, new, curve_ = _slope(table, tried)
            if found <= loss + 1e-4 * size * down or size < 1e-3:
                break
            size /= 2
        if found > loss:
            break
        change = new - slope
        if (tried - model) @ change > 1e-12:
            remembered.append((tried - model, change))
        done = loss - found < ENOUGH * abs(loss)
        model, loss, slope = tried, found, new
        if done:
            break
    return model


def score(model: np.ndarray, rows: DataFrame) -> DataFrame:
    """The rows with `score`, the probability of the label, instead of their features."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c not in ("places", "values")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = np.clip(_margins(batch, shared.value), -500, 500)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.names.index(c)) for c in kept], pa.array(1 / (1 + np.exp(-margin)))],
                names=[*kept, "score"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)
    return rows.mapInArrow(run, f"{kinds}, score double")
