"""Exact duplicates by an extendible-hash index kept as files in the shared folder.

The key of a text is a 64-bit hash of its normalised form, and a bucket of the index is a range of keys with a common
prefix. The directory doubles as long as a bucket holds more keys than fit: only overfull buckets split, by one more
bit. Rows are compared byte by byte under their key, copies of one task being merged before they are shuffled; then
owner tasks, each with a range of buckets, chain the different texts of a key and write the index.

Everything here is DataFrame work: no Python runs on the rows, nothing is collected, and what is broadcast has a
proven bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.native import lower_ascii
from ratingloom.llm.registry import load, prepare, query
from ratingloom.session import durable

CAPACITY = 4096  # keys of a bucket
KEY_BITS = 64
HOT_SHARE = 1024  # a group with more than this part of all rows is answered by broadcast: at most so many groups


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    # on pure ASCII the fast function does the same
    return F.when(F.length(whole) == F.octet_length(whole), F.lower(whole)).otherwise(lower_ascii(whole))


def key_of(text: Column, bits: int = KEY_BITS) -> Column:
    """Hash of a normalised text; only its leading `bits` count, fewer of them make texts collide."""
    key = F.xxhash64(text)
    return key if bits == KEY_BITS else F.shiftleft(F.shiftrightunsigned(key, KEY_BITS - bits), KEY_BITS - bits)


def prefix(key: Column, depth: int) -> Column:
    """The leading `depth` bits of a key as a number."""
    return F.shiftrightunsigned(key, KEY_BITS - depth) if depth else F.lit(0).cast("long")


def grow_directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) and the global depth: which bucket serves each value of the leading bits.

    `keys` (key) are distinct. The first depth is that of evenly spread keys; then overfull buckets are split by one
    more bit, and the directory doubles with each such round, until no bucket is overfull.
    """
    depth = max(0, (keys.count() - 1) // capacity).bit_length()
    settled: DataFrame | None = None
    while True:
        counts = durable(keys.groupBy(prefix(F.col("key"), depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n")))
        fits = counts.where((F.col("n") <= capacity) | F.lit(depth == KEY_BITS)).select(
            "prefix", F.lit(depth).alias("depth")
        )
        settled = fits if settled is None else settled.unionByName(fits)
        full = counts.where(F.col("n") > capacity).select("prefix")
        if depth == KEY_BITS or not full.limit(1).count():
            break
        keys = keys.withColumn("prefix", prefix(F.col("key"), depth)).join(full, "prefix", "left_semi").drop("prefix")
        depth += 1
    width = F.expr(f"shiftleft(1L, {depth} - depth)")
    first = F.col("prefix") * width
    slots = F.explode(F.sequence(first, first + width - 1))
    return durable(settled.select(slots.alias("slot"), first.alias("bucket"), "depth")), depth


@dataclass
class Index:
    """`entries`: doc_id, row, key, text_sha256 of every row. `chains`, the index itself: bucket, key, chain (place
    among the different texts of the key), text_sha256, keep_id, head (row that stays), group_size."""

    entries: DataFrame
    chains: DataFrame
    directory: DataFrame
    depth: int
    rows: int


def build_index(docs: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> Index:
    """Index of all rows of `docs` (doc_id, text); other columns are not read.

    Whether texts are equal is found by grouping their bytes under the key. The digest then names a text within its
    chain; two texts with one digest would end the job.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    entries = durable(
        source.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            key_of(F.col("text"), bits).alias("key"),
            F.sha2("text", 256).alias("text_sha256"),
        )
    )
    rows = entries.count()
    heads = entries.groupBy("key", "text_sha256").agg(F.max(F.struct("doc_id", -F.col("row"))).alias("head"))
    bytewise = source.groupBy(key_of(F.col("text"), bits).alias("key"), "text").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")
    )
    texts = durable(bytewise.select("key", F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id"))
    directory, depth = grow_directory(texts.select("key").distinct(), capacity)
    placed = (
        texts.join(heads, ["key", "text_sha256"])
        .withColumn("slot", prefix(F.col("key"), depth))
        .join(directory.select("slot", "bucket"), "slot")
        .repartitionByRange("bucket")
    )
    chain = Window.partitionBy("bucket", "key")
    same_digest = F.count(F.lit(1)).over(Window.partitionBy("bucket", "key", "text_sha256"))
    chained = placed.select(
        "bucket",
        "key",
        F.row_number().over(chain.orderBy("text_sha256")).alias("chain"),
        F.when(same_digest > 1, F.raise_error(F.lit("two texts with one digest"))).otherwise(
            F.col("text_sha256")
        ).alias("text_sha256"),
        "keep_id",
        (-F.col("head.col2")).alias("head"),
        "group_size",
    )
    return Index(entries, durable(chained.sortWithinPartitions("bucket", "key", "chain")), directory, depth, rows)


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> DataFrame:
    """doc_id, row, keep_id, group_size, kept, text_sha256: one row per row of `docs` (doc_id, text).

    Texts are equal when identical after lower-casing A-Z; null is empty. Of equal texts the row with the largest
    doc_id stays, a null id being smaller than all others; of repeated rows just one has `kept`. Without rows there is
    no result. Groups with more than a 1,024th of all rows are looked up in a broadcast of at most 1,024 of them, so no
    task gets all rows of a large group; all others are joined by key.
    """
    index = build_index(docs, capacity, bits)
    found = index.chains.select("key", "text_sha256", "keep_id", "head", "group_size")
    large = F.col("group_size") * HOT_SHARE > index.rows
    hot = found.where(large)
    names = hot.select("key", "text_sha256")
    many = index.entries.join(F.broadcast(hot), ["key", "text_sha256"])
    few = index.entries.join(F.broadcast(names), ["key", "text_sha256"], "left_anti").join(
        found.where(~large), ["key", "text_sha256"]
    )
    return many.unionByName(few).select(
        "doc_id", "row", "keep_id", "group_size", (F.col("row") == F.col("head")).alias("kept"), "text_sha256"
    )


@query(
    "op13_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
        doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM d
    """,
)
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_groups(load(spark, folder, "documents", "doc_id", "text")).drop("row")
