"""Drift of a current table against a reference table, column by column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.running import running_totals
from ratingloom.session import durable

KS_THRESHOLD = 0.1
JS_THRESHOLD = 0.1
CUTS = 65_536  # values of a numeric reference column that are kept


def _cells(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """(column_name, value, n): how often each value occurs."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _both(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(column_name, value, n_ref, n_cur) from the value counts of both sides."""
    nothing = F.lit(0).cast("long")
    ref = reference.select("column_name", "value", F.col("n").alias("n_ref"), nothing.alias("n_cur"))
    cur = current.select("column_name", "value", nothing.alias("n_ref"), F.col("n").alias("n_cur"))
    return ref.unionByName(cur).groupBy("column_name", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def numeric_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Kolmogorov-Smirnov distance of value counts (column_name, value, n): the largest gap of the cumulative shares."""
    counts = _both(reference, current)
    totals = running_totals(counts, ["value"], {"ref": F.col("n_ref"), "cur": F.col("n_cur")}, keys=["column_name"])
    gap = F.abs(
        F.try_divide(F.col("before_ref") + F.col("n_ref"), F.col("all_ref"))
        - F.try_divide(F.col("before_cur") + F.col("n_cur"), F.col("all_cur"))
    )
    return totals.groupBy("column_name").agg(F.max(gap).alias("drift_score")).select(
        "column_name",
        F.lit("ks").alias("test"),
        "drift_score",
        (F.col("drift_score") >= KS_THRESHOLD).alias("detected"),
    )


def categorical_drift(reference: DataFrame, current: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Jensen-Shannon distance (base 2) of value counts (column_name, value, n).

    Values that the current side doesn't have add half their reference share each, so the reference is only looked up
    for values that it has. `sizes` (column_name, n_ref) are the reference's totals, counted here if not given.
    """
    if sizes is None:
        sizes = reference.groupBy("column_name").agg(F.sum("n").alias("n_ref"))
    own = current.groupBy("column_name").agg(F.sum("n").alias("n_cur"))
    totals = sizes.join(own, "column_name", "full")  # one row per column
    known = reference.select(F.col("column_name").alias("__c"), F.col("value").alias("__v"), F.col("n").alias("__n"))
    same = (F.col("column_name") == F.col("__c")) & F.col("value").eqNullSafe(F.col("__v"))
    met = current.join(known, same, "left").join(F.broadcast(totals), "column_name")
    p, q = F.coalesce("__n", F.lit(0)) / F.col("n_ref"), F.col("n") / F.col("n_cur")
    mid = (p + q) / 2
    part = F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)
    sums = met.groupBy("column_name").agg(F.sum(part).alias("__sum"), F.sum(p).alias("__met"))
    # without the current side there is nothing in common: the largest divergence
    divergence = (F.coalesce("__sum", F.lit(0.0)) + 1 - F.coalesce("__met", F.lit(0.0))) / 2
    score = F.sqrt(F.greatest(F.round(divergence, 12), F.lit(0.0)))
    return totals.select("column_name").join(sums, "column_name", "left").select(
        "column_name", F.lit("js").alias("test"), score.alias("drift_score"), (score >= JS_THRESHOLD).alias("detected")
    )


def _typed(df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """The table with times as seconds, its numeric columns and its text columns."""
    times = [c for c, t in df.dtypes if t.startswith("timestamp")]
    df = df.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6 for c in times}) if times else df
    text = [c for c, t in df.dtypes if t == "string"]
    return df, [c for c in df.columns if c not in text], text


def column_counts(df: DataFrame) -> DataFrame:
    """(column_name, number, text, n): value counts of all columns, and n of all rows under an empty name. Counts of
    parts of a table add up, so they can be kept in its place."""
    df, numbers, text = _typed(df)
    tables = [df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("").alias("column_name"), F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("text"), "n"
    )]
    for columns, kind, own, other in ((numbers, "double", "number", "text"), (text, "string", "text", "number")):
        if columns:
            empty = F.lit(None).cast("string" if other == "text" else "double").alias(other)
            tables.append(_cells(df, columns, kind).select("column_name", F.col("value").alias(own), empty, "n").select(tables[0].columns))
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


@dataclass(frozen=True)
class Reference:
    """What is kept of a reference table: `cuts` (column_name, value, n) of its numbers, at most CUTS per column, each
    with all rows since the cut before it; `texts` (column_name, value, n); `sizes` (column_name, n_ref) of the texts."""

    cuts: DataFrame
    texts: DataFrame
    sizes: DataFrame
    numbers: tuple[str, ...]
    text: tuple[str, ...]


def keep_reference(reference: DataFrame, cuts: int | None = None) -> Reference:
    """Count the reference once. Distances of columns of more than `cuts` values are right to 1 / cuts."""
    cuts = cuts or CUTS
    df, numbers, text = _typed(reference)
    counted = durable(_cells(df, numbers, "double")) if numbers else _cells(df, text, "double").limit(0)
    totals = running_totals(counted, ["value"], {"n": F.col("n"), "values": F.lit(1)}, keys=["column_name"])
    slot = F.when(F.col("all_values") <= cuts, F.col("before_values")).otherwise(
        F.floor((F.col("before_n") + F.col("n") - 1) * cuts / F.col("all_n"))
    )
    # the last value of a slot stands for it; a null is smaller than all others
    kept = totals.groupBy("column_name", slot.alias("slot")).agg(F.max("value").alias("value"), F.sum("n").alias("n"))
    texts = durable(_cells(df, text, "string")) if text else counted.select("column_name", F.col("value").cast("string"), "n").limit(0)
    sizes = texts.groupBy("column_name").agg(F.sum("n").alias("n_ref"))
    return Reference(durable(kept.drop("slot")), texts, durable(sizes), tuple(numbers), tuple(text))


def drift_of_counts(reference: Reference, counts: DataFrame) -> DataFrame:
    """Drift per column of summed `column_counts` against what is kept of the reference."""
    parts = []
    if reference.numbers:
        own = counts.where(F.col("column_name").isin(*reference.numbers)).select("column_name", F.col("number").alias("value"), "n")
        parts.append(numeric_drift(reference.cuts, own))
    if reference.text:
        own = counts.where(F.col("column_name").isin(*reference.text)).groupBy("column_name", F.col("text").alias("value")).agg(F.sum("n").alias("n"))
        parts.append(categorical_drift(reference.texts, own, reference.sizes))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def column_drift(reference: DataFrame, current: DataFrame) -> DataFrame | None:
    """Drift per column of two tables of one schema; None (nothing to compare) when the schemas differ."""
    if [(f.name, f.dataType) for f in reference.schema] != [(f.name, f.dataType) for f in current.schema]:
        return None
    reference, numbers, text = _typed(reference)
    current = _typed(current)[0]
    parts = []
    if numbers:
        parts.append(numeric_drift(_cells(reference, numbers, "double"), _cells(current, numbers, "double")))
    if text:
        parts.append(categorical_drift(_cells(reference, text, "string"), _cells(current, text, "string")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
