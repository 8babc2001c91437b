"""Passages that repeat across documents: paragraph MinHash, verification, components.

A paragraph is a run of twenty words that begins at an anchor, the word of least hash among 31 neighbours. Equal
passages have equal anchors, wherever they stand, so a passage of fifty words holds at least one whole paragraph
of its own, also in the middle of a line. Paragraphs that collide in a band of their MinHash signature are joined
with the first paragraph of their bucket; the two documents are then aligned along that diagonal and those a few
words off, and a passage counts if it has fifty words and, by exact Jaccard similarity of five-word shingles, is at
least 0.8 similar.

Paragraphs that found no passage with the first of their bucket are compared among each other by their runs of
fifty words, so nothing hangs on which document comes first.

Of two copies the one in the greater row is removed, so whatever goes stays in a smaller row. Components of the
verified pairs name the group a removal belongs to.

Scale: band rows are numbers. Buckets are counted with map-side combine and joined with their first member only;
that join can be split when a bucket is large. Texts are shuffled once, and only to cut out the stretches that
collided, equal ones once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.components import components
from ratingloom.llm.registry import load, prepare, query
from ratingloom.llm.textbytes import Words, find_words, mix, shingles, text_chunks
from ratingloom.session import durable

SHINGLE = 5
PARAGRAPH = 20  # words
NEIGHBOURS = 31  # words among which one is the anchor; PARAGRAPH + NEIGHBOURS - 1 = LEAST_WORDS
LEAST_WORDS = 50  # of a repeated passage
SIMILARITY = 0.8
BANDS, ROWS = 2, 2  # equal paragraphs always meet; at similarity 0.8 a paragraph does with 0.87
BRIDGE = 3  # words that differ between two equal stretches of one passage, at most
GAP = 8  # the same where the passage as a whole is compared
REACH = 4  # words inserted or left out that shift one part of a passage against another, at most
_SPREAD = np.random.default_rng(31).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def row_key(text: Column) -> Column:
    """Names a row by id and text; rows alike in both are one document."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.coalesce(text, F.lit("")))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of `width` neighbours."""
    reach, low = 1, values
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def anchors(words: Words) -> np.ndarray:
    """First words of the paragraphs: in any NEIGHBOURS words that can begin one, those of least hash."""
    found = [np.zeros(0, np.int64)]
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        n = b - a - PARAGRAPH + 1
        if n <= 0:
            continue
        own = words.hashes[a : a + n]
        width = min(n, NEIGHBOURS)
        low = sliding_min(own, width)
        # the greatest of the least values of all runs that have a place in them
        ends = np.zeros(width - 1, np.uint64)
        reached = ~sliding_min(~np.concatenate([ends, low, ends]), width)
        found.append(a + np.flatnonzero(own == reached))
    return np.concatenate(found)


def band_keys(words: Words, at: np.ndarray) -> np.ndarray:
    """MinHash bands of the paragraphs that begin at the given words, one row each."""
    width = PARAGRAPH - SHINGLE + 1
    keys = np.zeros((len(at), BANDS), np.uint64)
    if not len(at):
        return keys
    # shingles by their first word, also across texts; paragraphs lie inside one text
    whole = Words(words.data, words.starts, words.ends, words.hashes, np.array([0, len(words.hashes)]))
    hashes, _ = shingles(whole, SHINGLE)
    for k, factor in enumerate(_SPREAD):
        low = sliding_min(mix(hashes * factor), width)[at]
        keys[:, k // ROWS] = mix(keys[:, k // ROWS] * np.uint64(31) + low + np.uint64(k // ROWS))
    return keys


def paragraph_bands(docs: DataFrame) -> DataFrame:
    """(bucket, row, pos): band keys of all paragraphs of `docs` (row, text). Of paragraphs of a text that share a key
    and overlap, as in a word said many times, only the first is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in text_chunks(batch.column(1)):
                words = find_words(data, offsets)
                at = anchors(words)
                keys = band_keys(words, at)
                owner = np.searchsorted(words.bounds, at, "right") - 1
                for band in range(BANDS):
                    order = np.lexsort((at, keys[:, band], owner))
                    key, text = keys[order, band], owner[order]
                    fresh = np.ones(len(order), bool)
                    fresh[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (np.diff(at[order]) >= PARAGRAPH)
                    keep = order[fresh]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array(keys[keep, band].view(np.int64)),
                            "row": pa.array(rows[first + owner[keep]]),
                            "pos": pa.array((at[keep] - words.bounds[owner[keep]]).astype(np.int32)),
                        }
                    )

    return docs.select("row", "text").mapInArrow(run, "bucket long, row long, pos int")


def alignments(bands: DataFrame) -> DataFrame:
    """(row, other, shift, low, high, paragraphs): stretches of words to compare with those `shift` words on in row
    `other`, the first row of a bucket. Paragraphs of one diagonal make one stretch, with room on both sides;
    `paragraphs` has their places."""
    first = bands.groupBy("bucket").agg(F.min(F.struct("row", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = first.where("n > 1").select("bucket", F.col("first.row").alias("other"), F.col("first.pos").alias("at"))
    return (
        bands.join(shared, "bucket")
        .where("row != other")
        .groupBy("row", "other", (F.col("at") - F.col("pos")).alias("shift"))
        .agg(
            (F.min("pos") - LEAST_WORDS).alias("low"),
            (F.max("pos") + PARAGRAPH + LEAST_WORDS).alias("high"),
            F.collect_set("pos").alias("paragraphs"),
        )
    )


def cut_stretches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, low, high, words): 32-bit word hashes of the wanted stretches (row, low, high), cut at the text's ends;
    words outside are zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(2).to_pylist()
            for first, end, data, offsets in text_chunks(batch.column(1)):
                words = find_words(data, offsets)
                short = ((words.hashes >> np.uint64(32)) | np.uint64(1)).astype("<u4")
                out = {"row": [], "low": [], "high": [], "words": []}
                for i in range(first, end):
                    own = short[words.bounds[i - first] : words.bounds[i - first + 1]]
                    for want in asked[i]:
                        low, high = want["low"], want["high"]
                        part = np.zeros(high - low, "<u4")
                        a, b = max(low, 0), min(high, len(own))
                        if b > a:
                            part[a - low : b - low] = own[a:b]
                        out["row"].append(batch.column(0)[i].as_py())
                        out["low"].append(low)
                        out["high"].append(high)
                        out["words"].append(part.tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(out["row"], pa.int64()), "low": pa.array(out["low"], pa.int32()),
                        "high": pa.array(out["high"], pa.int32()), "words": pa.array(out["words"], pa.binary()),
                    }
                )

    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("wanted"))
    chosen = docs.select("row", "text").join(lists, "row").dropDuplicates(["row"])
    return chosen.mapInArrow(run, "row long, low int, high int, words binary")


def _shingle_set(values: np.ndarray) -> set:
    return {values[i : i + SHINGLE].tobytes() for i in range(max(1, len(values) - SHINGLE + 1))}


def passage_similarity(left: np.ndarray, right: np.ndarray) -> float:
    a, b = _shingle_set(left), _shingle_set(right)
    return len(a & b) / len(a | b)


def repeated_passages(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, float]]:
    """(first, end, similarity) of the passages two aligned word rows have in common.

    Equal stretches that are at most BRIDGE words apart make one passage if it is similar enough; else, each
    stretch that is long enough is one. Zero stands for no word.
    """
    same = (left == right) & (left != 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    runs = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
    groups: list[list[tuple[int, int]]] = []
    for run in runs:
        if run[1] - run[0] < SHINGLE:
            continue
        if groups and run[0] - groups[-1][-1][1] <= BRIDGE:
            groups[-1].append(run)
        else:
            groups.append([run])
    found = []
    for group in groups:
        a, b = group[0][0], group[-1][1]
        if b - a >= LEAST_WORDS:
            alike = 1.0 if len(group) == 1 else passage_similarity(left[a:b], right[a:b])
            if alike >= SIMILARITY:
                found.append((a, b, alike))
                continue
        found += [(c, d, 1.0) for c, d in group if d - c >= LEAST_WORDS]
    return found


def _runs(left: np.ndarray, right: np.ndarray, diagonal: int) -> list[tuple[int, int, int]]:
    """(first word left, first word right, words) of the equal stretches with `diagonal` words between both places."""
    a, b = max(0, -diagonal), max(0, diagonal)
    n = min(len(left) - a, len(right) - b)
    same = (left[a : a + n] == right[b : b + n]) & (left[a : a + n] != 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    starts, sizes = edge[::2], np.diff(edge)[::2]
    return [(a + x, b + x, n) for x, n in zip(starts.tolist(), sizes.tolist()) if n >= SHINGLE]


def shifted_passages(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(first, end, first word right, similarity): the passages of `repeated_passages`, and those in which words were
    inserted or left out.

    Equal stretches on diagonals up to REACH words off follow each other if at most GAP words of either side lie
    between them; such a chain is a passage if both its sides have LEAST_WORDS words and are similar enough.
    """
    straight = repeated_passages(left, right)
    found = [(a, b, a, alike) for a, b, alike in straight]
    runs = sorted(r for d in range(-REACH, REACH + 1) for r in _runs(left, right, d))
    chains: list[list[tuple[int, int, int]]] = []
    for x, y, n in runs:
        if chains:
            at, to, size = chains[-1][-1]
            late = max(0, at + size - x, to + size - y)
            near = max(x + late - at - size, y + late - to - size) <= GAP
            if near and n - late >= SHINGLE:
                chains[-1].append((x + late, y + late, n - late))
                continue
            if x < at + size:  # beside the chain
                continue
        chains.append([(x, y, n)])
    for chain in chains:
        (a, c, _), (x, y, n) = chain[0], chain[-1]
        b, d = x + n, y + n
        if len(chain) == 1 or min(b - a, d - c) < LEAST_WORDS or any(p <= a and b <= q for p, q, _ in straight):
            continue
        alike = passage_similarity(left[a:b], right[c:d])
        if alike >= SIMILARITY:
            found = [f for f in found if not (a <= f[0] and f[1] <= b)] + [(a, b, c, alike)]
    return found


def gram_hashes(values: np.ndarray, size: int = LEAST_WORDS) -> np.ndarray:
    """A hash of each run of `size` values."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(values) - size + 1, np.uint64)
    step = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    wide = values.astype(np.uint64)
    for i in range(size):
        total += wide[i : i + len(total)] * step[i]
    return mix(total)


def compared(aligned: DataFrame, stretches: DataFrame) -> DataFrame:
    """Passages (row, first, n_words, other, other_first, similarity) that `row` shares with the first row of its
    bucket; and, with `gram` set, every run of fifty words around a paragraph that is in none of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, rows, firsts, grams = [], [], [], []
            for r in batch.to_pylist():
                left, right = (np.frombuffer(r[c], "<u4") for c in ("words", "other_words"))
                rest = gram_hashes(left)
                empty = np.concatenate([[0], np.cumsum(left == 0)])
                open_ = np.zeros(len(rest), bool)
                for at in r["paragraphs"]:
                    open_[max(0, at - r["low"] + PARAGRAPH - LEAST_WORDS) : at - r["low"] + 1] = True
                if len(rest):
                    open_ &= empty[LEAST_WORDS:] == empty[:-LEAST_WORDS]
                for a, b, c, alike in shifted_passages(left, right):
                    out.append((r["row"], r["low"] + a, b - a, r["other"], r["low"] + r["shift"] + c, alike, None))
                    open_[a : b - LEAST_WORDS + 1] = False
                at = np.flatnonzero(open_)
                rows.append(np.full(len(at), r["row"], np.int64))
                firsts.append((r["low"] + at).astype(np.int32))
                grams.append(rest[at].view(np.int64))
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            if rows and sum(map(len, rows)):
                size = sum(map(len, rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(rows)), pa.array(np.concatenate(firsts)),
                        *[pa.nulls(size, kind) for kind in kinds[2:6]], pa.array(np.concatenate(grams)),
                    ],
                    names=names,
                )

    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.int64())
    names = ["row", "first", "n_words", "other", "other_first", "similarity", "gram"]
    theirs = stretches.select(
        F.col("row").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"),
        F.col("words").alias("other_words"),
    )
    joined = (
        aligned.withColumn("other_low", F.col("low") + F.col("shift"))
        .withColumn("other_high", F.col("high") + F.col("shift"))
        .join(stretches, ["row", "low", "high"])
        .join(theirs, ["other", "other_low", "other_high"])
        .select("row", "other", "shift", "low", "paragraphs", "words", "other_words")
    )
    schema = "row long, first int, n_words int, other long, other_first int, similarity double, gram long"
    return joined.mapInArrow(run, schema)


def shared_rest(grams: DataFrame) -> DataFrame:
    """Passages among rows that have none with the first of their bucket there: equal runs of fifty words, each
    with the first row that has it. Runs that follow each other along one diagonal are one passage."""
    first = grams.groupBy("gram").agg(F.min(F.struct("row", "first")).alias("least"), F.max("row").alias("last"))
    first = first.where(F.col("last") > F.col("least.row"))
    pairs = (
        grams.join(first.select("gram", F.col("least.row").alias("other"), F.col("least.first").alias("at")), "gram")
        .where("row != other")
        .select("row", "other", (F.col("at") - F.col("first")).alias("shift"), "first")
        .distinct()
    )
    diagonal = Window.partitionBy("row", "other", "shift").orderBy("first")
    breaks = F.coalesce((F.col("first") - F.lag("first").over(diagonal) > 1).cast("int"), F.lit(1))
    return (
        pairs.withColumn("part", F.sum(breaks).over(diagonal))
        .groupBy("row", "other", "shift", "part")
        .agg(F.min("first").alias("first"), (F.max("first") - F.min("first") + LEAST_WORDS).alias("n_words"))
        .select("row", "first", "n_words", "other", (F.col("first") + F.col("shift")).alias("other_first"), F.lit(1.0).alias("similarity"))
    )


def find_repeats(docs: DataFrame) -> DataFrame:
    """row, first, n_words, other, other_first, similarity, cluster: passages of `row` to remove, and where they stay.

    `docs` has row, doc_id and text. The same words may be in several of the passages, with different partners.
    Texts of fewer than fifty words, null ones and repeats inside one text give none. `cluster` is the least
    passage (row and first word) that the pair is linked to.
    """
    bands = paragraph_bands(docs)
    aligned = durable(alignments(bands))
    mine = aligned.select("row", "low", "high")
    theirs = aligned.select(
        F.col("other").alias("row"),
        (F.col("low") + F.col("shift")).alias("low"),
        (F.col("high") + F.col("shift")).alias("high"),
    )
    stretches = durable(cut_stretches(docs, mine.unionByName(theirs).distinct()))
    both = durable(compared(aligned, stretches))
    rest = shared_rest(both.where("gram is not null").select("row", "first", "gram"))
    passages = durable(both.where("gram is null").drop("gram").unionByName(rest))
    here, there = F.struct("row", "first"), F.struct(F.col("other").alias("row"), F.col("other_first").alias("first"))
    links = passages.select(here.alias("a"), there.alias("b"))
    groups = components(links)
    return durable(passages.withColumn("node", here).join(groups, "node").withColumnRenamed("component", "cluster").drop("node"))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row", row_key(F.col("text")))


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, kept_doc_id, kept_first_word, similarity, cluster: one row per passage of a
    document (doc_id, text) that repeats one of another document, which keeps it. Words count from 0."""
    prepare(docs.sparkSession)
    rows = keyed(docs.select("doc_id", "text"))
    found = find_repeats(rows)
    names = rows.select("row", "doc_id").dropDuplicates(["row"])
    kept = names.select(F.col("row").alias("other"), F.col("doc_id").alias("kept_doc_id"))
    return (
        found.join(names, "row")
        .join(kept, "other")
        .select(
            "doc_id",
            F.col("first").cast("long").alias("first_word"),
            F.col("n_words").cast("long").alias("n_words"),
            "kept_doc_id",
            F.col("other_first").cast("long").alias("kept_first_word"),
            "similarity",
            F.xxhash64("cluster").alias("cluster"),
        )
    )


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All passages that repeat across documents."""
    return repeats(load(spark, folder, "documents", "doc_id", "text"))


def dedup_stage(docs: DataFrame) -> DataFrame:
    """Documents without the passages that another one keeps; all columns, with text and n_chars (if there) renewed.

    A document that loses all its words goes; others stay, unchanged if nothing of them repeats. The word after a
    removed passage follows the word before it, with the white space that stood before the passage.
    """
    prepare(docs.sparkSession)
    marked = docs.withColumn("__row", row_key(F.col("text")))
    rows = marked.select(F.col("__row").alias("row"), "doc_id", "text")
    spans = (
        find_repeats(rows)
        .groupBy(F.col("row").alias("__row"))
        .agg(F.collect_set(F.struct("first", (F.col("first") + F.col("n_words")).alias("end"))).alias("__spans"))
    )
    joined = marked.join(spans, "__row", "left").drop("__row")
    kept = list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(kept.index("text"))
            asked = batch.column(len(kept)).to_pylist()
            out, stays = [], []
            for i, (text, spans) in enumerate(zip(texts.to_pylist(), asked)):
                left = text if not spans or text is None else without(text, [(s["first"], s["end"]) for s in spans])
                out.append(left)
                stays.append(left is not None or text is None)
            columns = list(batch.columns[: len(kept)])
            columns[kept.index("text")] = pa.array(out, texts.type)
            if "n_chars" in kept:
                old = columns[kept.index("n_chars")]
                sizes = [len(t) if s and t is not None else n for t, s, n in zip(out, asked, old.to_pylist())]
                columns[kept.index("n_chars")] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays(columns, names=kept).filter(pa.array(stays))

    return joined.select(*kept, "__spans").mapInArrow(run, docs.schema)


def without(text: str, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans (first, end); None if no word is left."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = find_words(data, np.array([0, len(data)]))
    gone = np.zeros(len(words.starts), bool)
    for first, end in spans:
        gone[max(0, first) : end] = True
    if gone.all():
        return None
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    parts, at = [], 0
    for a, b in zip(edge[::2], edge[1::2]):
        begin = int(words.starts[a])
        # what follows the last word up to white space belongs to it
        end = int(words.ends[b - 1])
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        while end < len(data) and data[end] in b" \t\n\r\x0b\x0c":
            end += 1
        end = min(end, int(words.starts[b])) if b < len(words.starts) else end
        parts.append(data[at:begin].tobytes())
        at = end
    parts.append(data[at:].tobytes())
    return b"".join(parts).decode()
