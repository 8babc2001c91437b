"""One row per key, kept in buckets of a bounded size, of which a batch reads and writes only those it touches.

A bucket holds the keys whose hash begins with its bits. A batch writes its touched buckets anew under its own number,
then a list of where each bucket now lies; a bucket that has grown too large is split by further bits on that
occasion. So what a batch reads depends on its own keys and the size of a bucket, not on the number of all keys. A
batch that is run again begins from the list before it and replaces what it wrote, and a list that was not finished is
never read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import durable

CAPACITY = 100_000  # rows of a bucket
LISTS = "prefix long, depth int, batch long"
MOST_BITS = 40


@dataclass(frozen=True)
class Bucket:
    prefix: int
    depth: int
    batch: int  # that wrote it


class KeyedState:
    """State under `path`, by `keys`. Lists have one entry per bucket and go through the driver."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], capacity: int = CAPACITY) -> None:
        self.spark, self.path, self.keys, self.capacity = spark, path, list(keys), capacity

    def _hash(self, depth: int | Column) -> Column:
        """The leading bits of a key's hash."""
        bits = F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - MOST_BITS)
        shift = F.lit(MOST_BITS) - (F.lit(depth) if isinstance(depth, int) else depth)
        return F.call_function("shiftright", bits, shift)

    def batches(self, before: int | None = None) -> list[int]:
        """Numbers of the finished lists, ascending."""
        context = self.spark.sparkContext
        root = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/lists")
        files = root.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        found = []
        for status in files.listStatus(root):
            done = files.exists(context._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
            number = int(status.getPath().getName().partition("=")[2])
            if done and (before is None or number < before):
                found.append(number)
        return sorted(found)

    def buckets(self, before: int | None = None) -> list[Bucket]:
        """Where every bucket lies, or lay before a batch."""
        numbers = self.batches(before)
        if not numbers:
            return []
        rows = self.spark.read.schema(LISTS).parquet(f"{self.path}/lists/batch={numbers[-1]}").collect()
        return sorted((Bucket(r.prefix, r.depth, r.batch) for r in rows), key=lambda b: (b.depth, b.prefix))

    def _folder(self, bucket: Bucket) -> str:
        return f"{self.path}/rows/batch={bucket.batch}/bucket={bucket.depth}-{bucket.prefix}"

    def _read(self, buckets: Sequence[Bucket]) -> DataFrame | None:
        folders = [self._folder(b) for b in buckets if b.batch >= 0]
        return self.spark.read.parquet(*folders) if folders else None

    def current(self) -> DataFrame | None:
        """The row of every key; None before the first batch."""
        return self._read(self.buckets())

    def _placed(self, df: DataFrame, buckets: Sequence[Bucket]) -> DataFrame:
        """Add `__depth` and `__prefix` of each key's bucket: its leading bits at the deepest level, looked up."""
        deepest = max((b.depth for b in buckets), default=0)
        slots = [
            (slot, b.depth, b.prefix)
            for b in buckets
            for slot in range(b.prefix << (deepest - b.depth), (b.prefix + 1) << (deepest - b.depth))
        ]
        table = self.spark.createDataFrame(slots, "__slot long, __depth int, __prefix long")
        return df.withColumn("__slot", self._hash(deepest)).join(F.broadcast(table), "__slot").drop("__slot")

    def update(self, batch: DataFrame, number: int, advance: Callable[[DataFrame, DataFrame | None], DataFrame]) -> int:
        """Replace the rows of the batch's keys by those of advance(batch, known rows of its buckets).

        Returns how many stored rows were read. A batch without rows leaves everything as it is.
        """
        buckets = self.buckets(before=number) or [Bucket(0, 0, -1)]
        asked = self._placed(batch.select(*self.keys).distinct(), buckets).select("__depth", "__prefix").distinct()
        wanted = {(r["__depth"], r["__prefix"]) for r in asked.collect()}  # one row per bucket at most
        touched = [b for b in buckets if (b.depth, b.prefix) in wanted]
        if not touched:
            return 0
        known = self._read(touched)
        new = advance(batch, known)
        rows = new if known is None else new.unionByName(known.join(new.select(*self.keys), self.keys, "left_anti"))
        rows = durable(rows)
        # a full bucket is split by as many bits as it takes
        sizes = {
            (r["__depth"], r["__prefix"]): r["n"]
            for r in self._placed(rows, touched).groupBy("__depth", "__prefix").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        fresh = []
        for b in touched:
            parts = -(-sizes.get((b.depth, b.prefix), 0) // self.capacity)
            more = min(MOST_BITS - b.depth, max(0, parts - 1).bit_length())
            fresh += [Bucket((b.prefix << more) + i, b.depth + more, number) for i in range(1 << more)]
        placed = self._placed(rows, fresh).withColumn("bucket", F.concat_ws("-", "__depth", "__prefix")).drop("__depth", "__prefix")
        out = f"{self.path}/rows/batch={number}"
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        filled = {r["bucket"] for r in placed.select("bucket").distinct().collect()}
        fresh = [b if f"{b.depth}-{b.prefix}" in filled else Bucket(b.prefix, b.depth, -1) for b in fresh]
        kept = [b for b in buckets if b not in touched]
        table = self.spark.createDataFrame([(b.prefix, b.depth, b.batch) for b in kept + fresh], LISTS)
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lists/batch={number}")
        return 0 if known is None else known.count()  # from the footers of the files

    def clean(self) -> None:
        """Delete what neither of the last two lists names, so that a batch can still be run again."""
        numbers = self.batches()
        if len(numbers) < 2:
            return
        named = {self._folder(b) for before in (None, numbers[-1]) for b in self.buckets(before) if b.batch >= 0}
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        files = path(self.path).getFileSystem(context._jsc.hadoopConfiguration())
        for folder in files.listStatus(path(f"{self.path}/rows")):
            batch = folder.getPath().getName()
            for bucket in files.listStatus(folder.getPath()):
                name = bucket.getPath().getName()
                if name.startswith("bucket=") and f"{self.path}/rows/{batch}/{name}" not in named:
                    files.delete(bucket.getPath(), True)
        for old in numbers[:-2]:
            files.delete(path(f"{self.path}/lists/batch={old}"), True)
