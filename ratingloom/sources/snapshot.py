"""Newest row per key, kept as parquet that streaming batches add to.

A batch writes the folder batch=<number> with its own keys; from time to time one writes full=<number> with all keys.
Readers begin at the newest full folder, so what a lookup reads does not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by the order columns. Runs as an aggregate, so copies of a key meet before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(newest).select(*keys, "__r.*").select(*df.columns)


def _folders(spark: SparkSession, path: str, before: int | None) -> list[str]:
    """The folders a reader needs: the newest full one and the batches after it."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found: dict[str, list[int]] = {"full": [], "batch": []}
    for status in files.listStatus(root):
        kind, _, number = status.getPath().getName().partition("=")
        done = files.exists(context._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        if kind in found and done and (before is None or int(number) < before):
            found[kind].append(int(number))
    full = max(found["full"], default=None)
    later = sorted(n for n in found["batch"] if full is None or n > full)
    return ([f"{path}/full={full}"] if full is not None else []) + [f"{path}/batch={n}" for n in later]


def upsert_latest(
    batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], order: Sequence[str], compact_every: int = 0
) -> None:
    """Add the newest rows of a batch to the snapshot; every `compact_every` batches write all current rows anew.

    Every batch owns the folders of its number, so a replayed batch replaces its own rows and nothing else.
    """
    latest_rows(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    if compact_every and batch_id % compact_every == compact_every - 1:
        current = read_snapshot(batch.sparkSession, path, keys, order, before=batch_id + 1)
        current.write.mode("overwrite").parquet(f"{path}/full={batch_id}")


def read_snapshot(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], before: int | None = None
) -> DataFrame | None:
    """The current row of every key, or that before a batch; at equal order values the later batch wins. None if
    nothing has been written yet."""
    folders = _folders(spark, path, before)
    if not folders:
        return None
    rows = None
    for number, folder in enumerate(folders):
        part = spark.read.parquet(folder).withColumn("__batch", F.lit(number))
        rows = part if rows is None else rows.unionByName(part)
    return latest_rows(rows, keys, [*order, "__batch"]).drop("__batch")


def compact_snapshot(spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the current rows as the first full folder of a fresh snapshot."""
    read_snapshot(spark, path, keys, order).write.mode("overwrite").parquet(f"{target}/full=0")
