"""Document log-likelihood under a gated recurrent language model trained on the corpus itself.

Three passes over the texts. The first counts all training words. The second trains: every task runs truncated
backpropagation over its own documents from one common start, and the models are averaged by the words they have
seen, a weighted mean per parameter. The third scores every document as a whole, its state carried from the first
word to the last. Words outside the model's vocabulary follow their counts within a class given by their ending;
the counts of the rarer ones are looked up by a join, so no vocabulary that grows with the corpus goes to a task.

Bounds: a broadcast holds at most HEAD word counts and the parameters of the model. Words are known by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import gru
from ratingloom.llm.registry import load, prepare, query
from ratingloom.llm.textbytes import SPACED, Words, find_words, mix, text_chunks
from ratingloom.session import durable

HEAD = 1 << 18  # words whose counts every task has
GROUP = 4_000_000  # words that a task lays in lanes at a time
END = np.uint64(0x5851F42D4C957F2D)  # stands for the end of a document
HELD_OUT = 1
COUNT_FLUSH = 2_000_000


def remainder(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def rare_class(words: Words) -> np.ndarray:
    """Class of each word by its last three bytes, A-Z as lower case."""
    ending = np.zeros(len(words.starts), np.uint64)
    for i in range(1, 4):
        at = words.ends - i
        byte = np.where(at >= words.starts, words.data[np.maximum(at, 0)], 0).astype(np.uint64)
        byte += np.where((byte >= 65) & (byte <= 90), np.uint64(32), np.uint64(0))
        ending = (ending << np.uint64(8)) | byte
    return (mix(ending) % np.uint64(gru.RARE_CLASSES)).astype(np.int8)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, classes, bounds) of the words of some texts, each text followed by the end token."""
    words = find_words(data, offsets, SPACED)
    ends = words.bounds[1:]
    bounds = words.bounds + np.arange(len(words.bounds))
    hashes = np.insert(words.hashes, ends, END)
    classes = np.insert(rare_class(words), ends, 0)
    return hashes, classes, bounds


def count_words(texts: DataFrame) -> DataFrame:
    """(word, class, n): how often each word and the end token stand in `texts` (text), by word hash."""

    def summed(parts: list) -> pa.RecordBatch:
        words, classes, counts = (np.concatenate(p) for p in zip(*parts))
        unique, first, place = np.unique(words, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_pydict(
            {
                "word": pa.array(unique.view(np.int64)),
                "class": pa.array(classes[first]),
                "n": pa.array(np.bincount(place, weights=counts).astype(np.int64)),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                hashes, classes, _ = tokens(data, offsets)
                unique, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                parts.append((unique, classes[first], counts))
                size += len(unique)
                if size >= COUNT_FLUSH:
                    yield summed(parts)
                    parts, size = [], 0
        if parts:
            yield summed(parts)

    counted = texts.select("text").mapInArrow(run, "word long, class byte, n long")
    return counted.groupBy("word", "class").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the most frequent words (`words` ascending), the symbols of those the model knows, -1 for others, and
    the totals of the corpus. `mass` has, per rare class, the smoothed count of its words and one unknown."""

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    total: int
    distinct: int
    mass: np.ndarray
    symbol_counts: np.ndarray

    @property
    def end(self) -> int:
        return int(self.symbols[np.searchsorted(self.words, END)])

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, known): where in `words` each hash stands, if it does."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def read(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The symbols the model reads: frequent words, and the classes of others."""
        at, known = self.look_up(hashes)
        own = np.where(known, self.symbols[at], -1)
        return np.where(own >= 0, own, classes.astype(np.int64) + gru.FREQUENT).astype(np.int32)


def build_vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """From word counts (word, class, n). The head is all words from a count on, chosen so that at most `head` are."""
    steps = F.floor(F.log2("n") * 16)
    levels = counts.groupBy(steps.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    levels = sorted(levels.collect(), key=lambda r: -r["level"])  # about a thousand rows at most
    least, taken = None, 0
    for row in levels:
        taken += row["words"]
        if taken > head:
            break
        least = row["least"]
    own = counts.where(F.col("n") >= (least if least is not None else 1 << 62)) if levels else counts
    end = np.array([END]).view(np.int64)[0]
    table = own.unionByName(counts.where(F.col("word") == F.lit(int(end)))).distinct().toPandas()
    words = np.append(table["word"].to_numpy(np.int64), np.zeros(0, np.int64)).view(np.uint64)
    number = table["n"].to_numpy(np.int64)
    if END not in words:  # no training text at all
        words, number = np.append(words, END), np.append(number, 0)
    order = np.argsort(words)
    words, number = words[order], number[order]
    symbols = np.full(len(words), -1)
    frequent = [int(np.searchsorted(words, END))]
    for i in np.lexsort((words, -number)).tolist():
        if len(frequent) == gru.FREQUENT:
            break
        if words[i] != END:
            frequent.append(i)
    frequent.sort(key=lambda i: (-number[i], words[i]))
    symbols[frequent] = np.arange(len(frequent))
    known = [int(v) for v in words[frequent].view(np.int64)]
    totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    rest = (
        counts.where(~F.col("word").isin(known))
        .groupBy("class")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
        .collect()
    )
    mass, symbol_counts = np.full(gru.RARE_CLASSES, 0.5), np.zeros(gru.SYMBOLS)
    for row in rest:
        mass[row["class"]] += row["n"] + 0.5 * row["words"]
        symbol_counts[gru.FREQUENT + row["class"]] = row["n"]
    symbol_counts[: len(frequent)] = number[frequent]
    return Vocabulary(words, number, symbols, int(totals[0] or 0), int(totals[1]), mass, symbol_counts)


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple]:
    """(rows, hashes, classes, bounds) of about GROUP words at a time; rows are the batches' other columns."""
    kept, parts, size = [], [], 0

    def joined() -> tuple:
        hashes, classes, bounds = (list(p) for p in zip(*parts))
        moved, at = [np.zeros(1, np.int64)], 0
        for b in bounds:
            moved.append(b[1:] + at)
            at += int(b[-1])
        return pa.Table.from_batches(kept), np.concatenate(hashes), np.concatenate(classes), np.concatenate(moved)

    for batch in batches:
        for row, end, data, offsets in text_chunks(batch.column(column)):
            others = [i for i in range(batch.num_columns) if i != column]
            kept.append(batch.slice(row, end - row).select(others))
            parts.append(tokens(data, offsets))
            size += len(parts[-1][0])
            if size >= GROUP:
                yield joined()
                kept, parts, size = [], [], 0
    if parts:
        yield joined()


def train(texts: DataFrame, vocabulary: Broadcast) -> np.ndarray:
    """Parameters of the model, learned from all of `texts` (text): the mean over tasks, weighted by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        trainer, seen = gru.Trainer(gru.initial(known.symbol_counts)), 0
        for _, hashes, classes, bounds in _groups(batches, 1):
            trainer.train(gru.lay(known.read(hashes, classes), bounds), known.end)
            seen += len(hashes)
        if trainer.seen:
            trainer.step()
        if seen:
            places = np.arange(gru.SIZE, dtype=np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "place": pa.array(places),
                    "value": pa.array(trainer.model.vector.astype(np.float64) * seen),
                    "seen": pa.array(np.full(gru.SIZE, seen, np.int64)),
                }
            )

    learned = texts.select(F.lit(0).alias("none"), "text").mapInArrow(run, "place int, value double, seen long")
    mean = learned.groupBy("place").agg((F.sum("value") / F.sum("seen")).alias("value"))
    table = mean.toPandas()  # one row per parameter
    vector = gru.initial(vocabulary.value.symbol_counts)
    vector[table["place"].to_numpy()] = table["value"].to_numpy()
    return vector


def score_heads(docs: DataFrame, vocabulary: Broadcast, vector: Broadcast) -> DataFrame:
    """Per row of `docs` (doc_id, remainder, text): sums over its tokens, without the counts of words outside the
    head, which are in `tail`."""
    schema = (
        "doc_id long, remainder long, row long, n_tokens long, n_known long, base double, model double, "
        "tail array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = vocabulary.value, gru.Model(vector.value)
        counts = np.log10(known.counts + 0.5)
        mass = np.log10(known.mass)
        for rows, hashes, classes, bounds in _groups(batches, 3):
            symbols = known.read(hashes, classes)
            logs = model.score(gru.lay(symbols, bounds), known.end, len(symbols)) / np.log(10)
            at, head = known.look_up(hashes)
            own = np.where(head, counts[at], 0.0)
            rare = symbols >= gru.FREQUENT
            logs[rare] += own[rare] - mass[symbols[rare] - gru.FREQUENT]
            doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            size = len(bounds) - 1
            tail = hashes[~head].view(np.int64)
            tail_bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[~head], minlength=size))])
            rows = rows.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(i).chunk(0) for i in range(3)],
                    pa.array(np.diff(bounds)),
                    pa.array(np.bincount(doc, weights=head & (known.counts[at] > 0), minlength=size).astype(np.int64)),
                    pa.array(np.bincount(doc, weights=own, minlength=size)),
                    pa.array(np.bincount(doc, weights=logs, minlength=size)),
                    pa.ListArray.from_arrays(tail_bounds.astype(np.int32), pa.array(tail)),
                ],
                names=[part.split()[0] for part in schema.split(", ")],
            )

    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "remainder", F.monotonically_increasing_id().alias("row"), "text"
    )
    return marked.mapInArrow(run, schema)


def score_documents(docs: DataFrame, held_out: int = HELD_OUT, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of `docs` (doc_id, text).

    Trained on the rows whose crc32 of the id does not leave `held_out` by 5; a null id counts as remainder 0.
    Scores are log10 probabilities of all words and the end. A null or empty text is its end alone. Without any
    training text every word is unknown.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select("doc_id", remainder(F.col("doc_id")).alias("remainder"), "text")
    training = rows.where(F.col("remainder") != held_out)
    counts = durable(count_words(training))
    known = build_vocabulary(counts, head)
    vocabulary = spark.sparkContext.broadcast(known)
    vector = spark.sparkContext.broadcast(train(training, vocabulary))
    heads = durable(score_heads(rows, vocabulary, vector))
    wanted = heads.select("row", F.explode("tail").alias("word"))
    found = wanted.join(counts.hint("shuffle_hash").select("word", "n"), "word", "left")
    tails = found.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_log"), F.count("n").alias("tail_known")
    )
    divisor = float(np.log10(known.total + 0.5 * (known.distinct + 1)))
    tail = F.coalesce("tail_log", F.lit(0.0))
    return (
        heads.drop("tail")
        .join(tails, "row", "left")
        .select(
            "doc_id",
            (F.col("remainder") == held_out).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("long").alias("train_tokens"),
            (F.col("base") + tail - F.col("n_tokens") * F.lit(divisor)).alias("base_score"),
            (F.col("model") + tail).alias("score"),
        )
    )


@query("op3_lm_score")
def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log-likelihood of every document."""
    return score_documents(load(spark, folder, "documents", "doc_id", "text"))
