"""Toxicity classifier with a counterfactual penalty.

A logistic model over the words of a text and their beginnings. Each labelled text that names a group is paired
with itself after identity terms are swapped for others of their group; the squared change of the score joins the
loss, so the weight of a mere group mention is driven to that of its counterparts and neutral mentions pass.

Scale: fitted on a bounded sample of labelled rows (`rows`, chosen by md5 of the id, so always the same). All
else covers every row: texts are scored where they are read, by at most `features` weights sent to the tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.registry import load, prepare, query
from ratingloom.session import durable

ROWS = 20_000  # labelled rows the model is fitted on, at most
FEATURES = 512
LEAST_TEXTS = 3  # labelled texts a feature must occur in
LEAST_Z = 5.0  # with some 100,000 features to choose from, a smaller difference may be chance
RIDGE = 0.002
PENALTY = 4.0  # weight of a squared score change under a swap
STEPS = 30
BEGINNINGS = (4, 6, 8)  # letters; inflected words share them

WORD = re.compile(r"[^\W\d_]+")
IDENTITIES = (
    "christian muslim jewish hindu buddhist atheist catholic protestant",
    "christians muslims jews hindus buddhists atheists catholics protestants",
    "man woman", "men women", "boy girl", "boys girls", "male female", "he she", "his her", "father mother",
    "black white asian latino arab african european american",
    "gay straight lesbian bisexual", "heterosexual homosexual", "transgender cisgender", "old young",
    "blind sighted", "deaf hearing", "immigrant native", "immigrants natives", "german french spanish english",
    "mann frau", "männer frauen", "christ jude", "christen juden muslime", "schwarz weiß",
    "homme femme", "hommes femmes", "chrétien musulman juif", "chrétiens musulmans juifs", "noir blanc",
    "hombre mujer", "hombres mujeres", "cristiano musulmán judío", "cristianos musulmanes judíos", "negro blanco",
)


def _swaps() -> dict[str, str]:
    pairs = {}
    for group in IDENTITIES:
        terms = group.split()
        for term, other in zip(terms, [*terms[1:], terms[0]]):
            pairs.setdefault(term, other)
    return pairs


SWAP = _swaps()


def words_of(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def swapped(words: Counter) -> Counter | None:
    """The words after all identity terms are swapped; None without any."""
    named = words.keys() & SWAP.keys()
    if not named:
        return None
    other = Counter({w: n for w, n in words.items() if w not in named})
    for w in named:
        other[SWAP[w]] += words[w]
    return other


def beginnings(words: Counter, size: int) -> Counter:
    heads = Counter()
    for word, n in words.items():
        if len(word) > size:
            heads[word[:size]] += n
    return heads


def features_of(words: Counter) -> Counter:
    """The words, and their beginnings with a trailing asterisk, with their numbers."""
    found = Counter(words)
    for size in BEGINNINGS:
        found.update({f"{head}*": n for head, n in beginnings(words, size).items()})
    return found


def amount(n: int) -> float:
    """What n occurrences count for: each further one less."""
    return math.log2(1 + n)


@dataclass(frozen=True)
class Model:
    """weights by feature, and the bias; without weights or bias all texts score 0."""

    weights: dict[str, float]
    bias: float | None

    def scores(self, texts: Iterable[str]) -> list[float]:
        if self.bias is None:
            return [0.0 for _ in texts]
        whole = {f: w for f, w in self.weights.items() if not f.endswith("*")}
        begin = {f[:-1]: w for f, w in self.weights.items() if f.endswith("*")}
        sizes = sorted({len(f) for f in begin})
        totals = []
        for text in texts:
            words = words_of(text)
            total = self.bias + math.fsum(whole[w] * amount(words[w]) for w in words.keys() & whole.keys())
            for size in sizes:
                heads = beginnings(words, size)
                total += math.fsum(begin[h] * amount(heads[h]) for h in heads.keys() & begin.keys())
            totals.append(total)
        return (1 / (1 + np.exp(-np.clip(totals, -40, 40)))).tolist()


def held_out(doc_id: Column, part: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(text, toxic) of at most `rows` labelled training documents.

    An id labelled twice is toxic if any label says so; of documents that share an id one is taken. The chosen
    ids, a bounded table, are broadcast, so texts are not shuffled to find theirs.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    chosen = (
        known.groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(durable(chosen)), "doc_id")
    first = Window.partitionBy("doc_id").orderBy("text")
    return texts.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")
    )


def choose_features(sample: DataFrame, features: int = FEATURES) -> list[str]:
    """The features whose share differs most between the classes, by a two-sample z statistic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[1 if toxic else 0].update(features_of(words_of(text)).keys())
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(names, pa.string()),
                "clean": pa.array([seen[0][n] for n in names], pa.int64()),
                "toxic": pa.array([seen[1][n] for n in names], pa.int64()),
            }
        )

    sizes = sample.agg(F.sum((F.col("toxic") == 0).cast("long")), F.sum((F.col("toxic") != 0).cast("long"))).first()
    clean, toxic = (n or 0 for n in sizes)
    if not clean or not toxic:
        return []
    shares = F.col("toxic") / toxic - F.col("clean") / clean
    spread = F.sqrt((F.col("toxic") + F.col("clean") + 1) * (1 / clean + 1 / toxic) / (clean + toxic))
    counted = (
        sample.mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= LEAST_TEXTS)
        .withColumn("z", F.abs(shares / spread))
        .where(F.col("z") >= LEAST_Z)
    )
    return [r["feature"] for r in counted.orderBy(F.desc("z"), "feature").limit(features).select("feature").collect()]


def training_rows(sample: DataFrame, chosen: list[str]) -> list:
    """toxic, the text's features as (place, amount), and those after the swap (null without identity terms)."""
    place = {f: i for i, f in enumerate(chosen)}

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(words: Counter) -> list[tuple[int, float]]:
            found = features_of(words)
            return sorted((place[f], amount(found[f])) for f in found.keys() & place.keys())

        kind = pa.list_(pa.struct([("place", pa.int32()), ("amount", pa.float64())]))
        for batch in batches:
            own, other = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                swap = swapped(words)
                own.append([{"place": p, "amount": a} for p, a in row(words)])
                other.append(None if swap is None else [{"place": p, "amount": a} for p, a in row(swap)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(own, kind), pa.array(other, kind)], names=["toxic", "own", "other"]
            )

    pairs = "array<struct<place:int,amount:double>>"
    return sample.mapInArrow(look_up, f"toxic int, own {pairs}, other {pairs}").collect()


def fit_weights(
    toxic: np.ndarray, own: list, other: list, features: int, penalty: float = PENALTY, ridge: float = RIDGE
) -> np.ndarray:
    """Weights and, last, the bias: Newton steps on the class-balanced log loss, a ridge and the swap penalty.

    `own` and `other` hold (place, amount) pairs per text; `other` is None for texts without identity terms.
    """

    def matrix(rows: list) -> np.ndarray:
        x = np.zeros((len(rows), features + 1), np.float32)
        for line, pairs in zip(x, rows):
            for place, value in pairs:
                line[place] = value
        return x

    x = matrix(own)
    paired = [i for i, pairs in enumerate(other) if pairs is not None]
    change = x[paired] - matrix([other[i] for i in paired])
    x[:, -1] = 1
    positive = toxic.sum()
    balance = np.where(toxic == 1, len(toxic) / (2 * positive), len(toxic) / (2 * (len(toxic) - positive)))
    weights = np.zeros(features + 1)
    shrink = np.full(features + 1, ridge * len(toxic) / 100)
    shrink[-1] = 1e-6
    swap_pull = penalty * (change.T @ change).astype(np.float64)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ (balance * (p - toxic)) + shrink * weights + swap_pull @ weights
        curve = (x * (balance * p * (1 - p))[:, None].astype(np.float32)).T @ x
        step = np.linalg.solve(curve.astype(np.float64) + swap_pull + np.diag(shrink), slope)
        weights -= step
        if np.abs(step).max() < 1e-3:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, features: int = FEATURES, penalty: float = PENALTY) -> Model:
    """Fit on the labelled documents whose crc32 of the id leaves no remainder 0 by 5.

    Without a labelled text of either class, or a feature that tells them apart, there is no model, and every text
    scores 0.
    """
    prepare(docs.sparkSession)
    sample = durable(labelled_sample(docs, labels, rows))
    chosen = choose_features(sample, features)
    if not chosen:
        return Model({}, None)
    read = training_rows(sample, chosen)
    toxic = np.asarray([1 if r["toxic"] else 0 for r in read])
    weights = fit_weights(toxic, [r["own"] for r in read], [r["other"] for r in read], len(chosen), penalty)
    return Model(dict(zip(chosen, weights[:-1].tolist())), float(weights[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every column of `docs` (with `text`) and `score`; a null text scores as an empty one. An existing column of
    that name is replaced."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]
    schema = docs.select(*kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(kept.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.scores(texts), pa.float64())], names=[*kept, "score"])

    return docs.select(*kept).mapInArrow(run, schema)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    model = fit(docs, load(spark, folder, "labels", "doc_id", "toxic"))
    scored = score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not reject (score below 0.5), all columns as they came."""
    scored = score(docs.withColumnRenamed("score", "__score") if "score" in docs.columns else docs, fit(docs, labels))
    kept = scored.where("score < 0.5").drop("score")
    return kept.withColumnRenamed("__score", "score") if "score" in docs.columns else kept
