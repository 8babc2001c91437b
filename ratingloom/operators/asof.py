"""As-of join: the newest feature row at or before a moment, within a time-to-live."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.times import DAY_MS
from ratingloom.operators.ordered import last_known
from ratingloom.operators.skew import find_cuts


def asof_join(
    requests: DataFrame,
    features: DataFrame,
    key: str,
    request_at: str,
    feature_at: str,
    columns: Sequence[str],
    ttl_days: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """For each distinct (key, moment) the feature columns of the newest row with time in [t - ttl, t].

    Both sides go through one shuffle on the key: a union in time order, where features come first at equal
    times, and a fill-forward. Requests without a match stay, with nulls; `matched_at` is the feature time.
    Features must be unique in (key, time). Join the result back with `attach_features`. `counted` may name
    a cheap frame whose rows per key tell which keys are heavy.
    """
    wanted = requests.select(key, F.col(request_at).alias("__at")).distinct()
    found = F.struct(F.col(feature_at).alias("matched_at"), *columns)
    known = features.select(key, F.col(feature_at).alias("__at"), F.lit(0).alias("__side"), found.alias("__found"))
    timeline = known.unionByName(wanted.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    cuts = find_cuts(timeline, key, "__at", counted=counted)
    filled = last_known(timeline, key, ["__at", "__side"], "__found", cuts).where(F.col("__side") == 1)
    alive = F.col("__found.matched_at").isNotNull()
    if ttl_days is not None:
        alive = alive & (F.col("__found.matched_at") >= F.col("__at") - ttl_days * DAY_MS)
    return filled.select(
        key,
        F.col("__at").alias(request_at),
        *[F.when(alive, F.col(f"__found.{c}")).alias(c) for c in ("matched_at", *columns)],
    )


def asof_attach(
    rows: DataFrame,
    features: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    ttl_days: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The rows, each with the feature columns of the newest feature row of its key with time in [t - ttl, t].

    As `asof_join`, but the rows themselves lie in the timeline: they are shuffled once, and nothing is joined back.
    Both sides name their time `at`. A row without key or time has no features.
    """
    own = [c for c in rows.columns if c not in (key, at)]
    found = F.struct(F.col(at).alias("matched_at"), *columns)
    known = features.select(key, F.col(at).alias("__at"), F.lit(0).alias("__side"), found.alias("__found"))
    wanted = rows.select(key, F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(F.lit(1).alias("__own"), *own).alias("__kept"))
    timeline = known.unionByName(wanted, allowMissingColumns=True)
    cuts = find_cuts(timeline, key, "__at", counted=counted)
    filled = last_known(timeline, key, ["__at", "__side"], "__found", cuts).where(F.col("__side") == 1)
    alive = F.col(key).isNotNull() & F.col("__found.matched_at").isNotNull() & F.col("__at").isNotNull()
    if ttl_days is not None:
        alive = alive & (F.col("__found.matched_at") >= F.col("__at") - ttl_days * DAY_MS)
    return filled.select(
        key, F.col("__at").alias(at), *[F.col(f"__kept.{c}") for c in own],
        *[F.when(alive, F.col(f"__found.{c}")).alias(c) for c in columns],
    )
