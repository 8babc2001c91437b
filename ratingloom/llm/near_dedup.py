"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A text is its five-word shingles, weighted by count times inverse document frequency. Consistent samples of the
weighted set agree between two texts as often as their weighted Jaccard similarity; bands of three samples bring
similar texts together, and each candidate pair is verified by its exact weighted Jaccard similarity.

Document frequencies are counted over all texts in a fixed number of hash buckets, so the table that goes to the
tasks has the same size for any corpus; only shingles found in a good part of all texts stand out in it, which is
what the weight is for.

Groups: texts with the same words are one node from the start. In a large bucket, members are compared with the two
that meet most others; members of buckets that this leaves in several components go through an exact prefix-filter
join on rare shingles, across components only. That is linear in a bucket of one group and in one of texts that share
a passage only; it grows with the square of texts that lie just below the threshold to very many others and share
nearly all their rare shingles with them. Buckets are pre-aggregated before the shuffle, and joins to a large
bucket's pivots can be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm.components import components
from ratingloom.llm.registry import load, prepare, query
from ratingloom.llm.textbytes import Words, find_words, mix, shingles, text_chunks
from ratingloom.session import durable

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3  # of each measure; a pair that either puts at 0.8 meets in some band with probability 0.9992
BUCKETS = 1 << 16  # of document frequencies
POOL = 1 << 16  # random triples per sample, chosen by shingle hash
SMALL = 8  # members of a bucket of which all pairs are compared
LOAD = 1 << 18  # buckets of the counts by which shingles are called rare
SLACK = 1e-4  # for rounding, where a bound must not drop a pair
SEED = 29

_POOL: list[np.ndarray] = []


def _pool() -> list[np.ndarray]:
    """The random numbers of the sampling scheme: r, 1 / r, ln c - r and beta per pool place; multipliers."""
    if not _POOL:
        rng = np.random.default_rng(SEED)
        r, c, beta = rng.gamma(2, 1, POOL), rng.gamma(2, 1, POOL), rng.random(POOL)
        spread = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        _POOL.extend([r.astype(np.float32), (1 / r).astype(np.float32), (np.log(c) - r).astype(np.float32), beta.astype(np.float32), spread])
    return _POOL


def weighted_shingles(words: Words, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, weights, bounds): distinct shingles of each text in ascending order; weights are counts without a
    weight table."""
    hashes, bounds = shingles(words, SHINGLE)
    owner = np.repeat(np.arange(words.texts()), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    hashes = hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    counts = np.diff(np.append(at, len(hashes)))
    hashes = hashes[at]
    if weights is not None:
        counts = counts * weights[bucket_of(hashes)]
    return hashes, counts, np.searchsorted(owner[at], np.arange(words.texts() + 1))


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def sample_bands(hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Band keys, one row per text; rows of texts without shingles mean nothing."""
    r, inverse, start, beta, spread = _pool()
    texts = len(bounds) - 1
    full = np.flatnonzero(np.diff(bounds))
    begin = bounds[:-1][full]
    owner = np.repeat(np.arange(len(full)), np.diff(bounds)[full])
    log_weight = np.log(weights).astype(np.float32)
    keys = np.zeros((texts, BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        at = ((hashes * spread[k]) >> np.uint64(48)).astype(np.int64)
        t = np.floor(log_weight * inverse[at] + beta[at])
        a = start[at] - r[at] * (t - beta[at])
        least = np.minimum.reduceat(a, begin) if len(full) else a
        # of the shingles with the least value the first: they ascend by hash
        ties = np.flatnonzero(a == least[owner])
        first = ties[np.searchsorted(owner[ties], np.arange(len(full)))]
        drawn = mix(hashes[first] + t[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        keys[full, k // ROWS] = mix(keys[full, k // ROWS] * np.uint64(31) + drawn + np.uint64(k // ROWS))
    return keys


def plain_bands(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Band keys of the sets without their weights, one row per text; rows of texts without shingles mean nothing."""
    spread = _pool()[4]
    full = np.flatnonzero(np.diff(bounds))
    begin = bounds[:-1][full]
    keys = np.zeros((len(bounds) - 1, BANDS), np.uint64)
    for k in range(BANDS * ROWS if len(full) else 0):
        least = mix(np.minimum.reduceat(hashes * spread[k], begin))
        keys[full, k // ROWS] = mix(keys[full, k // ROWS] * np.uint64(31) + least + np.uint64(k // ROWS))
    return keys


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Weight per bucket, ln(1 + texts / texts with a shingle of the bucket), from all rows of `texts` (text).

    Every task counts its texts into one table of fixed size before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                words = find_words(data, offsets)
                hashes, _, _ = weighted_shingles(words, None)
                table += np.bincount(bucket_of(hashes), minlength=BUCKETS)
                rows += int((np.diff(words.bounds) > 0).sum())
        used = np.flatnonzero(table)
        places, counts = np.append(used, -1), np.append(table[used], rows)
        for at in range(0, len(places), 1 << 14):
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(places[at : at + (1 << 14)], pa.int32()), "n": pa.array(counts[at : at + (1 << 14)], pa.int64())}
            )

    counted = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # BUCKETS + 1 rows at most
    total = int(table.loc[table.bucket < 0, "n"].sum())
    df = np.ones(BUCKETS)
    used = table[table.bucket >= 0]
    df[used.bucket.to_numpy()] = np.maximum(used.n.to_numpy(), 1)
    return np.log1p(max(total, 1) / df).astype(np.float32)


def fingerprints(docs: DataFrame, weights: Broadcast) -> DataFrame:
    """(doc_id, digest, row, content, bands): `content` names the word sequence, null without words. The bands are
    those of the weighted sets, then those of the plain ones, as `similarity` takes the higher of both measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column(3)):
                words = find_words(data, offsets)
                hashes, weight, bounds = weighted_shingles(words, table)
                keys = np.hstack([sample_bands(hashes, weight, bounds), plain_bands(hashes, bounds)]).view(np.int64)
                content = [
                    hashlib.blake2b(words.hashes[a:b].tobytes(), digest_size=16).hexdigest() if b > a else None
                    for a, b in zip(words.bounds[:-1], words.bounds[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(row, end - row) for i in range(3)],
                        pa.array(content, pa.string()),
                        pa.ListArray.from_arrays(np.arange(0, keys.size + 1, 2 * BANDS, dtype=np.int32), keys.ravel()),
                    ],
                    names=["doc_id", "digest", "row", "content", "bands"],
                )

    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        "text",
    )
    return marked.mapInArrow(run, "doc_id long, digest long, row long, content string, bands array<long>")


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Jaccard similarity of two weighted sets given as (ascending hashes, weights): the weighted one, or the plain
    one of the sets if that is higher. A large group of near copies lowers the weight of what it shares, which must
    not part it."""
    common, at, to = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = np.minimum(left[1][at], right[1][to]).sum()
    total = left[1].sum() + right[1].sum() - shared
    plain = len(common) / max(1, len(left[0]) + len(right[0]) - len(common))
    return max(plain, float(shared / total) if total else 0.0)


def verify(pairs: DataFrame, texts: DataFrame, weights: Broadcast, least: float) -> DataFrame:
    """The pairs (a, b) of contents whose texts (content, text) are at least that similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            sides = []
            for column in (2, 3):
                sets = []
                for _, _, data, offsets in text_chunks(batch.column(column)):
                    hashes, weight, bounds = weighted_shingles(find_words(data, offsets), table)
                    sets += [(hashes[a:b], weight[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                sides.append(sets)
            alike = np.array([similarity(x, y) for x, y in zip(*sides)])
            yield batch.filter(pa.array(alike >= least - 1e-6)).select([0, 1])

    left = texts.select(F.col("content").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("content").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a string, b string")


def bucket_keys() -> Column:
    """One key for each of the bands."""
    return F.explode(F.array(*[F.xxhash64(F.lit(i), F.get("bands", F.lit(i))) for i in range(2 * BANDS)]))


def sized(texts: DataFrame, weights: Broadcast) -> DataFrame:
    """(content, n, mass): number and total weight of the distinct shingles of each of the texts (content, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            n, mass = [], []
            for _, _, data, offsets in text_chunks(batch.column(1)):
                _, weight, bounds = weighted_shingles(find_words(data, offsets), table)
                total = np.concatenate([[0.0], np.cumsum(weight, dtype=np.float64)])
                n.append(np.diff(bounds))
                mass.append(total[bounds[1:]] - total[bounds[:-1]])
            yield pa.RecordBatch.from_pydict(
                {
                    "content": batch.column(0),
                    "n": pa.array(np.concatenate(n) if n else [], pa.int64()),
                    "mass": pa.array(np.concatenate(mass) if mass else [], pa.float64()),
                }
            )

    return texts.select("content", "text").mapInArrow(run, "content string, n long, mass double")


def can_be_alike(x: str, y: str, least: float) -> Column:
    """Whether the sizes of two sets allow that similarity; no set is more alike to another than their sizes are."""
    ratio = lambda size: F.least(F.col(f"{x}.{size}"), F.col(f"{y}.{size}")) >= (least - 1e-4) * F.greatest(
        F.col(f"{x}.{size}"), F.col(f"{y}.{size}")
    )
    return ratio("n") | ratio("mass")


def compared(pairs: DataFrame, texts: DataFrame, weights: Broadcast, least: float) -> DataFrame:
    """(node, component) from the verified ones of `pairs` (a, b)."""
    return durable(components(durable(verify(durable(pairs.distinct()), texts, weights, least))))


def placed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """`members` (content, ...) with the component of each content, itself if it has no link yet."""
    named = classes.withColumnRenamed("node", "content")
    return members.join(named, "content", "left").withColumn("component", F.coalesce("component", "content"))


def shingle_load(texts: DataFrame) -> np.ndarray:
    """How many of `texts` (text) have a shingle of each of LOAD hash buckets: one table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(LOAD, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                hashes, _, _ = weighted_shingles(find_words(data, offsets), None)
                table += np.bincount(load_bucket(hashes), minlength=LOAD)
        used = np.flatnonzero(table)
        for at in range(0, len(used), 1 << 14):
            some = used[at : at + (1 << 14)]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(table[some], pa.int64())})

    counted = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # LOAD rows at most
    table = np.zeros(LOAD, np.int64)
    table[found.bucket.to_numpy()] = found.n.to_numpy()
    return table


def load_bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - LOAD.bit_length() + 1)).astype(np.int64)


def prefixes(texts: DataFrame, weights: Broadcast, load: Broadcast, least: float) -> DataFrame:
    """(shingle, content, component, n, mass, n_left, mass_left) of the shingles of `texts` (content, component, text)
    by which a text can be found.

    The shingles of a text are put in one order for all texts, those of rare buckets first. If two texts are `least`
    similar, the first shingle they share has enough of either text from there on; `n_left` and `mass_left` say how
    much that is. Shingles with too little left to be the first, or found in no other text, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, common = weights.value, load.value
        for batch in batches:
            for row, _, data, offsets in text_chunks(batch.column(2)):
                hashes, weight, bounds = weighted_shingles(find_words(data, offsets), table)
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                often = common[load_bucket(hashes)]
                order = np.lexsort((hashes, often, owner))
                hashes, often, weight = hashes[order], often[order], weight[order].astype(np.float64)
                before = np.concatenate([[0.0], np.cumsum(weight)])
                mass = (before[bounds[1:]] - before[bounds[:-1]])[owner]
                mass_left = before[bounds[1:]][owner] - before[:-1]
                n = np.diff(bounds)[owner]
                n_left = bounds[1:][owner] - np.arange(len(owner))
                kept = (often > 1) & ((n_left >= (least - SLACK) * n) | (mass_left >= (least - SLACK) * mass))
                at = pa.array(owner[kept] + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[kept].view(np.int64)),
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        *[pa.array(c[kept].astype(np.float64)) for c in (n, mass, n_left, mass_left)],
                    ],
                    names=["shingle", "content", "component", "n", "mass", "n_left", "mass_left"],
                )

    return texts.select("content", "component", "text").mapInArrow(
        run, "shingle long, content string, component string, n double, mass double, n_left double, mass_left double"
    )


def joined_by_prefix(found: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of different components that share a shingle of `found` with enough of both texts left."""
    lists = found.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    several = durable(found.join(lists.where("x != y").select("shingle"), "shingle", "left_semi"))
    x, y = several.alias("x"), several.alias("y")

    def enough(size: str) -> Column:
        both = F.col(f"x.{size}") + F.col(f"y.{size}")
        return F.least(f"x.{size}_left", f"y.{size}_left") >= (least / (1 + least) - SLACK) * both

    alike = (enough("n") | enough("mass")) & can_be_alike("x", "y", least)
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") < F.col("y.component")) & alike).select(
        F.col("x.content").alias("a"), F.col("y.content").alias("b")
    )


def linked(members: DataFrame, texts: DataFrame, weights: Broadcast, least: float) -> DataFrame:
    """(node, component) of the texts that a chain of verified pairs ties to others. `members` has bucket, content,
    members (the size of the bucket) and score, the number of texts that a content meets in all its buckets.

    Of a bucket of up to SMALL members all pairs are compared, of a larger one each member with the two of highest
    score, as the text that others are copies of meets most of them. Members of larger buckets that this leaves in
    several components then find each other by the rare shingles that any two similar texts must share, an exact
    search that has nothing to do with the bands; only pairs across components are made. Texts that differ from all
    others in more than their similarity allows have no such shingle in common with any.
    """
    sizes = sized(texts, weights)
    what = F.struct("score", "content", "n", "mass").alias("m")
    members = durable(members.join(sizes, "content").select("bucket", "members", what))
    few, many = members.where(F.col("members") <= SMALL), members.where(F.col("members") > SMALL)
    x, y = few.select("bucket", F.col("m").alias("p")), few.select("bucket", "m")
    within = x.join(y, "bucket").where((F.col("p.content") < F.col("m.content")) & can_be_alike("m", "p", least))
    best = many.groupBy("bucket").agg(F.max("m").alias("high"))
    rest = many.join(best, "bucket").where("m.content != high.content").groupBy("bucket", "high")
    both = rest.agg(F.max("m").alias("low")).select("bucket", F.explode(F.array("high", "low")).alias("p"))
    stars = many.join(both, "bucket").where((F.col("m.content") != F.col("p.content")) & can_be_alike("m", "p", least))
    pair = F.least("m.content", "p.content").alias("a"), F.greatest("m.content", "p.content").alias("b")
    classes = compared(within.select(*pair).unionByName(stars.select(*pair)), texts, weights, least)

    named = durable(placed(many.select("bucket", F.col("m.content").alias("content")), classes))
    ends = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    waiting = named.join(ends.where("x != y").select("bucket"), "bucket", "left_semi").select("content", "component")
    waiting = durable(texts.join(waiting.distinct(), "content"))
    load = texts.sparkSession.sparkContext.broadcast(shingle_load(waiting.select("text")))
    pairs = joined_by_prefix(durable(prefixes(waiting, weights, load, least)), least)
    found = verify(durable(pairs.distinct()), texts, weights, least)
    # links between components of before
    ends = waiting.select("content", "component")
    for side in ("a", "b"):
        other = ends.select(F.col("content").alias(side), F.col("component").alias(f"{side}_component"))
        found = found.join(other, side)
    joined = components(durable(found.select(F.col("a_component").alias("a"), F.col("b_component").alias("b"))))
    merged = durable(joined.select(F.col("node").alias("component"), F.col("component").alias("whole")))
    alone = merged.join(classes.select("component").distinct(), "component", "left_anti")
    return durable(
        classes.join(merged, "component", "left")
        .select("node", F.coalesce("whole", "component").alias("component"))
        .unionByName(alone.select(F.col("component").alias("node"), F.col("whole").alias("component")))
    )


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, digest, row, class_id, class_size, keep: one row per row of `docs` (doc_id, text).

    A class holds the texts linked by chains of pairs at least `least` similar; class_id is its smallest doc_id,
    and exactly one row of it has keep. Texts of the same words are one class. Null and wordless texts are
    classes of their own, one per row. Texts of fewer than five words have one shingle of all their words.
    """
    spark = prepare(docs.sparkSession)
    table = document_frequencies(docs.select("text"))
    weights = spark.sparkContext.broadcast(table)
    prints = durable(fingerprints(docs, weights))
    nodes = prints.where("content is not null").groupBy("content").agg(F.min(F.struct("doc_id", "digest", "bands")).alias("n"))
    nodes = durable(nodes.select("content", "n.*"))
    buckets = nodes.select("content", bucket_keys().alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = durable(buckets.join(shared, "bucket"))
    scores = durable(members.groupBy("content").agg(F.sum("members").alias("score")))
    nodes = nodes.join(scores, "content")
    sources = docs.select(
        F.col("doc_id").cast("long").alias("__id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__digest"), "text"
    )
    same = (F.col("doc_id").eqNullSafe(F.col("__id"))) & (F.col("digest") == F.col("__digest"))
    wanted = nodes.select("content", "doc_id", "digest")
    texts = durable(sources.join(wanted, same).select("content", "text").dropDuplicates(["content"]))
    classes = linked(members.join(scores, "content"), texts, weights, least)
    placed = prints.drop("bands").join(classes.withColumnRenamed("node", "content"), "content", "left")
    own_class = F.coalesce("component", "content", F.concat(F.lit("row "), F.col("row").cast("string")))
    placed = durable(placed.withColumn("component", own_class))
    heads = placed.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("head"), F.count(F.lit(1)).alias("class_size")
    )
    return placed.join(heads, "component").select(
        "doc_id",
        "digest",
        "row",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("head.row")).alias("keep"),
    )


@query("op9_near_dedup")
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near_duplicates(load(spark, folder, "documents", "doc_id", "text")).drop("digest", "row")


def near_dedup_stage(docs: DataFrame) -> DataFrame:
    """One document of each class, all columns as they came."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("keep").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__kept")
    )
    marked = docs.withColumn("__digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    # rows alike in id and text are one class: one of them stays
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    one = marked.where(~wordless).join(kept, same, "left_semi").dropDuplicates(["doc_id", "__digest"])
    return one.unionByName(marked.where(wordless)).drop("__digest")
