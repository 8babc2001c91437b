"""Item encoders: category one-hot, category counts, scaled price, standardised statistics, text weights.

Fitting reads the fit rows with aggregates only; what a fitted encoder holds is a short vocabulary or a few
numbers, and transforming is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.text import parse_price
from ratingloom.operators.running import running_totals
from ratingloom.session import durable

MAX_VOCABULARY = 20_000  # of the dense forms, which hold one number per category and row; the sparse ones have no limit

# Text weighting of titles and descriptions.
TEXT_MIN_DOCS = 5
TEXT_MAX_TERMS = 1000
TEXT_PARTS = 16  # into which a partition of texts is cut
GAP = r"[^\p{L}\p{N}_]+"  # terms are the runs of at least two characters between gaps


def _vocabulary(values: DataFrame) -> tuple:
    """Sorted distinct values of a one-column frame; refuses more than MAX_VOCABULARY."""
    rows = values.distinct().limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError("too many categories for a vocabulary")
    found = [r[0] for r in rows]
    return tuple(sorted(v for v in found if v is not None)) + ((None,) if None in found else ())


def _literal(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


@dataclass(frozen=True)
class OneHot:
    """One 0/1 per category of the fit rows; null is a category of its own; an unseen one gives zeros."""

    column: str
    levels: tuple

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> OneHot:
        return cls(column, _vocabulary(df.select(column)))

    def __call__(self) -> Column:
        named = _literal([v for v in self.levels if v is not None])
        value = F.col(self.column)
        flags = F.transform(named, lambda v: F.when(value.isNotNull() & (v == value), 1.0).otherwise(0.0))
        if None in self.levels:
            flags = F.concat(flags, F.array(F.when(value.isNull(), 1.0).otherwise(0.0)))
        return flags


@dataclass(frozen=True)
class CategoryCounts:
    """How often each lower-cased category of the fit rows occurs; an empty list counts as one empty category."""

    column: str
    terms: tuple

    @staticmethod
    def tokens(column: str) -> Column:
        return F.split(F.lower(F.array_join(F.coalesce(F.col(column), F.array().cast("array<string>")), "\n")), "\n")

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> CategoryCounts:
        return cls(column, _vocabulary(df.select(F.explode(cls.tokens(column)))))

    def __call__(self) -> Column:
        tokens = self.tokens(self.column)
        return F.transform(
            _literal(self.terms), lambda t: F.size(F.filter(tokens, lambda x: x == t)).cast("double")
        )


@dataclass(frozen=True)
class ScaledPrice:
    """Parsed price, unreadable as 0, scaled so the fit rows span 0..1; a constant scales by 1."""

    column: str
    low: float
    high: float

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> ScaledPrice:
        price = F.coalesce(parse_price(F.col(column)), F.lit(0.0))
        row = df.agg(F.min(price), F.max(price)).first()
        return cls(column, row[0], row[1])

    def __call__(self) -> Column:
        width = (self.high - self.low) or 1.0
        return (F.coalesce(parse_price(F.col(self.column)), F.lit(0.0)) - self.low) / width


@dataclass(frozen=True)
class Standardised:
    """Columns with nulls as 0, minus mean, over population deviation; a constant divides by 1."""

    columns: tuple
    means: tuple
    deviations: tuple

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> Standardised:
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
        row = df.agg(*[f(v) for v in filled.values() for f in (F.avg, F.stddev_pop)]).first()
        return cls(tuple(columns), tuple(row[::2]), tuple(row[1::2]))

    def each(self) -> list[Column]:
        return [
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - m) / (d or 1.0)
            for c, m, d in zip(self.columns, self.means, self.deviations)
        ]

    def __call__(self) -> Column:
        return F.array(*self.each())


@dataclass(frozen=True)
class ItemEncoder:
    """All of the above side by side, then every position standardised over the fit rows."""

    parts: tuple
    means: tuple
    deviations: tuple

    @classmethod
    def fit(cls, df: DataFrame, stat_columns: Sequence[str]) -> ItemEncoder:
        parts = (
            OneHot.fit(df, "main_category"),
            CategoryCounts.fit(df, "categories"),
            ScaledPrice.fit(df, "price"),
            Standardised.fit(df, stat_columns),
        )
        raw = df.select(array_to_vector(cls._joined(parts)).alias("v"))
        row = raw.select(Summarizer.metrics("mean", "std", "count").summary(F.col("v")).alias("s")).select(
            "s.mean", "s.std", "s.count"
        ).first()
        # the summary divides by n - 1, the scaler by n
        shrink = ((row["count"] - 1) / row["count"]) ** 0.5 if row["count"] else 0.0
        return cls(parts, tuple(float(m) for m in row["mean"]), tuple(float(s) * shrink for s in row["std"]))

    @staticmethod
    def _joined(parts) -> Column:
        one_hot, counts, price, stats = parts
        return F.concat(one_hot(), counts(), F.array(price()), stats())

    @property
    def width(self) -> int:
        return len(self.means)

    def __call__(self) -> Column:
        means = F.array(*[F.lit(m) for m in self.means])
        widths = F.array(*[F.lit(d if d > 1e-12 else 1.0) for d in self.deviations])
        centred = F.zip_with(self._joined(self.parts), means, lambda v, m: v - m)
        return F.zip_with(centred, widths, lambda v, d: v / d)


def level_table(values: DataFrame) -> DataFrame:
    """(level, pos): the distinct values of a one-column frame in order, a null last. Stays a table, of any size."""
    levels = values.select(F.col(values.columns[0]).alias("level")).distinct()
    order = [F.col("level").isNull(), F.col("level")]
    return durable(running_totals(levels, order, {"levels": F.lit(1).cast("long")}).select("level", F.col("before_levels").alias("pos")))


def one_hot_entries(df: DataFrame, levels: DataFrame, identity: str, column: str) -> DataFrame:
    """(identity, pos, value 1): where the one of each row stands; an unseen category has no entry."""
    same = F.col("__value").eqNullSafe(F.col("level"))
    rows = df.select(identity, F.col(column).alias("__value")).join(levels, same)
    return rows.select(identity, "pos", F.lit(1.0).alias("value"))


def category_entries(df: DataFrame, levels: DataFrame, identity: str, column: str) -> DataFrame:
    """(identity, pos, value): how often each lower-cased category occurs, for those that do."""
    tokens = df.select(identity, F.explode(CategoryCounts.tokens(column)).alias("level"))
    counted = tokens.groupBy(identity, "level").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counted.join(levels, "level").select(identity, "pos", "value")


def item_features(df: DataFrame, fit: DataFrame, identity: str, stat_columns: Sequence[str]) -> DataFrame:
    """(identity, pos, value): one-hot category, category counts, price and statistics side by side, as sparse entries;
    categories that the fit rows don't have are left out. Vocabularies are tables of any size, looked up by joins."""
    kinds, names = level_table(fit.select("main_category")), level_table(fit.select(F.explode(CategoryCounts.tokens("categories"))))
    first, second = (t.agg(F.count(F.lit(1))).first()[0] for t in (kinds, names))
    price, stats = ScaledPrice.fit(fit, "price"), Standardised.fit(fit, stat_columns)
    dense = F.array(*[
        F.struct(F.lit(first + second + i).cast("long").alias("pos"), v.alias("value"))
        for i, v in enumerate([price(), *stats.each()])
    ])
    return durable(
        one_hot_entries(df, kinds, identity, "main_category")
        .unionByName(category_entries(df, names, identity, "categories").withColumn("pos", F.col("pos") + first))
        .unionByName(df.select(identity, F.inline(dense)))
    )


def item_entries(df: DataFrame, fit: DataFrame, identity: str, stat_columns: Sequence[str]) -> DataFrame:
    """The entries of `item_features`, every position standardised over the fit rows.

    An absent entry stands for -mean / deviation of its position, the same for all rows, so the sparse form has all
    there is to know. The moments are one aggregate.
    """
    entries = item_features(df, fit, identity, stat_columns)
    rows = fit.agg(F.count(F.lit(1))).first()[0]
    known = entries.join(fit.select(identity), identity, "left_semi")
    mean, square = F.sum("value") / rows, F.sum(F.col("value") * F.col("value")) / rows
    width = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
    moments = known.groupBy("pos").agg(mean.alias("__mean"), F.when(width > 1e-9, width).otherwise(1.0).alias("__width"))
    return entries.join(moments, "pos").select(identity, "pos", ((F.col("value") - F.col("__mean")) / F.col("__width")).alias("value"))


def term_counts(documents: DataFrame, identity: str, text: str) -> DataFrame:
    """(identity, term, n): words of two or more letters and pairs of adjacent words, with their numbers.

    Texts are shuffled once, to the task of their document, and taken apart there, so words and pairs are counted where
    they are. Equal rows of a document count for its words each, for its pairs once.
    """
    # splitting at the gaps is several times cheaper than extracting every match
    parts = F.split(F.lower(F.coalesce("__t", F.lit(""))), GAP)
    words = F.filter(parts, lambda w: F.length(w) >= 2)
    # a task holds the terms of its part, several times its size
    partitions = TEXT_PARTS * max(documents.rdd.getNumPartitions(), documents.sparkSession.sparkContext.defaultParallelism)
    own = documents.select(identity, F.col(text).alias("__t")).repartition(partitions, identity).groupBy(identity, "__t")
    rows = own.agg(F.count(F.lit(1)).alias("__copies")).select(identity, "__copies", words.alias("__w"))
    behind = F.size("__w") - 1
    pairs = F.when(behind > 0, F.zip_with(
        F.slice("__w", 1, F.greatest(behind, F.lit(0))), F.slice("__w", 2, F.greatest(behind, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)
    )).otherwise(F.array().cast("array<string>"))
    kinds = F.array(F.struct(F.col("__w").alias("terms"), F.col("__copies").alias("n")), F.struct(
        pairs.alias("terms"), F.lit(1).cast("long").alias("n")
    ))
    each = rows.select(identity, F.inline(kinds)).select(identity, F.explode("terms").alias("term"), "n")
    return durable(each.groupBy(identity, "term").agg(F.sum("n").alias("n")))


def term_vocabulary(
    counts: DataFrame, n_docs: Column, min_docs: int = TEXT_MIN_DOCS, max_terms: int = TEXT_MAX_TERMS
) -> DataFrame:
    """(term, df, idf): terms in enough documents, the most frequent ones only; ties in alphabetical order.

    A pair is not more frequent than either of its words. So words are counted first, and if there are enough of them,
    pairs with a word that is rarer than all that would be kept are left out before they are shuffled.
    """
    pair = F.contains("term", F.lit(" "))
    numbers = F.count(F.lit(1)).alias("df"), F.sum("n").alias("total")
    words = durable(counts.where(~pair).groupBy("term").agg(*numbers))
    best = words.where(F.col("df") >= min_docs).orderBy(F.desc("total")).limit(max_terms)
    several, least = best.agg(F.count(F.lit(1)), F.min("total")).first()
    pairs = counts.where(pair)
    if several >= max_terms:
        known = durable(words.where(F.col("total") >= least).select("term"))
        for place in (1, 2):
            word = F.split_part("term", F.lit(" "), F.lit(place))
            pairs = pairs.withColumn("__word", word).join(known.withColumnRenamed("term", "__word"), "__word", "left_semi")
    found = words.unionByName(pairs.groupBy("term").agg(*numbers))
    kept = found.where(F.col("df") >= min_docs).orderBy(F.desc("total"), "term").limit(max_terms)
    return kept.select("term", "df", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf(counts: DataFrame, vocabulary: DataFrame, identity: str) -> DataFrame:
    """(identity, term, weight): count x idf at length one per document. The vocabulary has at most max_terms rows."""
    known = counts.join(F.broadcast(vocabulary.select("term", "idf")), "term").withColumn("__w", F.col("n") * F.col("idf"))
    whole = Window.partitionBy(identity)  # at most max_terms rows per document
    length = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(whole))
    return known.select(identity, "term", (F.col("__w") / length).alias("weight"))
