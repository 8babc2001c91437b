"""Data quality rules, all evaluated in one pass."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.clean import DataProblem

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Complete:
    """No nulls in the column."""

    column: str

    @property
    def name(self) -> str:
        return f'IsComplete "{self.column}"'

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InRange:
    """Values lie in [low, high]; a null passes."""

    column: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        if self.high is None:
            return f'ColumnValues "{self.column}" >= {self.low}'
        return f'ColumnValues "{self.column}" between {self.low} and {self.high}'

    def broken(self) -> Column:
        value = F.col(self.column)
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low)
        if self.high is not None:
            outside = outside | (value > self.high)
        return F.coalesce(outside, F.lit(False))


Rule = Complete | InRange

# The rules on the two feature tables.
MEAN_LOW, MEAN_HIGH = 0.99, 5.01
ITEM_RULES: tuple[Rule, ...] = (
    Complete("item_id"),
    Complete("event_ts"),
    InRange("item_rating_cnt_365d", 0),
    InRange("item_rating_cnt_90d", 0),
    InRange("item_rating_cnt_30d", 0),
    InRange("item_rating_cnt_7d", 0),
    InRange("item_rating_avg_365d", MEAN_LOW, MEAN_HIGH),
    InRange("item_rating_avg_90d", MEAN_LOW, MEAN_HIGH),
    InRange("item_rating_avg_30d", MEAN_LOW, MEAN_HIGH),
    InRange("item_rating_avg_7d", MEAN_LOW, MEAN_HIGH),
)
USER_RULES: tuple[Rule, ...] = (
    Complete("user_id"),
    Complete("event_ts"),
    InRange("user_rating_cnt_90d", 0),
    InRange("user_rating_avg_90d", MEAN_LOW, MEAN_HIGH),
)


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, outcome, fail_count, evaluated_rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(r.broken()).alias(f"__{i}") for i, r in enumerate(rules)]
    )
    lines = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(f"__{i}").alias("fail_count")) for i, r in enumerate(rules)
    ])
    return counts.select("__rows", F.inline(lines)).select(
        "rule",
        F.when(F.col("fail_count") == 0, "Passed").otherwise("Failed").alias("outcome"),
        "fail_count",
        F.col("__rows").alias("evaluated_rows"),
    )


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows, or DataProblem that names the failed rules."""
    failed = [r["rule"] for r in evaluate(df, rules).where("fail_count > 0").collect()]
    for rule in failed:
        log.error("rule failed: %s", rule)
    if failed:
        raise DataProblem("failed rules: " + "; ".join(failed))
    return df
