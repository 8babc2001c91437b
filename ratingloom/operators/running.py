"""Running totals over a whole table in sort order, without one global task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.session import durable

PART = "__part"


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    totals: dict[str, Column],
    keys: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add `before_<name>`, the exclusive running sum of each column, and `all_<name>`, the grand sum.

    Sums restart per value of `keys` (few values, such as column names). Rows must be unique in
    (keys, order). The table is range-partitioned by (keys, order) and kept durable, so partition numbers
    stay fixed; the offsets are one row per (partition, key), summed in a window over that short table.
    """
    ordering = [*keys, *order]
    measures = df.withColumns({f"__v_{name}": value for name, value in totals.items()})
    ranged = (
        measures.repartitionByRange(partitions, *ordering) if partitions else measures.repartitionByRange(*ordering)
    )
    ranged = durable(ranged.withColumn(PART, F.spark_partition_id()))
    per_part = ranged.groupBy(PART, *keys).agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in totals])
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_part.select(
        PART,
        *keys,
        *[F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in totals],
        *[F.sum(f"__s_{n}").over(whole).alias(f"all_{n}") for n in totals],
    )
    inside = Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = {f"__b_{n}": F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) for n in totals}
    joined = ranged.withColumns(local).join(offsets, [PART, *keys])
    return joined.select(
        *df.columns,
        *[(F.col(f"__o_{n}") + F.col(f"__b_{n}")).alias(f"before_{n}") for n in totals],
        *[f"all_{n}" for n in totals],
    )
