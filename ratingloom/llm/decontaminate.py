"""Benchmark decontamination over a distributed positional inverted index (DataFrame operations only).

The index holds one posting (document, position, term) for each training token whose term occurs in the
benchmark; other tokens can't be part of a match. A benchmark window is looked up from its rarest terms: the
lists of its two rarest terms are read, each position is moved back by the term's offset in the item, and the
places where both lists agree are the candidates. Only those are then compared, term by term, with the postings
of the other words. A candidate with every word in place is an exact phrase match, one with at least 80 % of
them a proximity match.

Scale: one pass over the texts writes the index; all later steps read only short integer rows. Every shuffle is
keyed by (document, position) or (document, item, diagonal), so neither a frequent term nor a passage that
a third of all documents share meets in one task. Term and window tables are as large as the benchmark and are
broadcast only if Spark finds them small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.native import plain_words
from ratingloom.llm.registry import load, query
from ratingloom.session import durable

WINDOW = 10  # words
RAREST = 2  # lists that are intersected first
NEAR = 0.8  # share of a window's words in place that makes a proximity match


def item_terms(items: DataFrame) -> DataFrame:
    """(item_no, item_id, n, ipos, term): the words of each benchmark row; rows without words have none."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), plain_words(F.col("text")).alias("words"))
    numbered = durable(rows.distinct().withColumn("item_no", F.monotonically_increasing_id()))
    return durable(
        numbered.select("item_no", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("ipos", "term"))
    )


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(row, doc_id, pos, term_id, n_words): the postings of terms in `vocabulary` (term, term_id).

    `row` tells rows of `docs` apart, also those that repeat an id. Every row has one entry at position -1, which
    carries n_words, so that documents without postings are kept; null texts have no words.
    """
    tokens = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.concat(F.array(F.lit(None).cast("string")), plain_words(F.col("text"))).alias("words"),
        )
        .withColumn("n_words", F.size("words") - 1)
        .select("row", "doc_id", "n_words", F.posexplode("words").alias("__at", "term"))
    )
    found = tokens.join(vocabulary, "term", "left").where("term_id is not null or __at = 0")
    own = F.when(F.col("__at") == 0, F.col("n_words"))
    return found.select("row", "doc_id", (F.col("__at") - 1).alias("pos"), "term_id", own.alias("n_words"))


def windows_by_rarity(terms: DataFrame, frequency: DataFrame, width: int, rarest: int) -> DataFrame:
    """(item_no, wins): per item its windows as array of (first, width, rare); `rare` has the item positions of the
    `rarest` least frequent terms of the window. Windows with a term that no document has are left out of the
    exact search but kept for proximity: their rare terms are the least frequent that occur at all."""
    last = F.greatest(F.col("n") - width, F.lit(0))
    inside = terms.join(frequency, "term", "left").withColumn(
        "first",
        F.explode(F.sequence(F.greatest(F.col("ipos") - (width - 1), F.lit(0)), F.least(F.col("ipos"), last))),
    )
    by_rarity = Window.partitionBy("item_no", "first").orderBy("frequency", "ipos")
    return (
        inside.where("frequency is not null")
        .withColumn("__rank", F.row_number().over(by_rarity))
        .groupBy("item_no", "first", F.least(F.col("n"), F.lit(width)).alias("width"))
        .agg(F.array_sort(F.collect_list(F.when(F.col("__rank") <= rarest, F.col("ipos")))).alias("rare"))
        .groupBy("item_no")
        .agg(F.array_sort(F.collect_list(F.struct("first", "width", "rare"))).alias("wins"))
    )


def _covered(windows: Column) -> Column:
    """Item positions inside any of the windows, ascending."""
    each = F.transform(windows, lambda w: F.sequence(w["first"], w["first"] + w["width"] - 1))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def find_matches(
    docs: DataFrame, items: DataFrame, width: int = WINDOW, rarest: int = RAREST, near: float = NEAR
) -> tuple[DataFrame, DataFrame]:
    """(rows, matches). rows: row, doc_id, n_words. matches: row, item_id, shift, exact, nearly.

    A match lies on one diagonal: item position p stands at document position p + shift. `exact` and `nearly` are
    the document positions inside windows with all words, or `near` of them, in place. Items of fewer than
    `width` words are one window; empty ones never match.
    """
    terms = item_terms(items)
    vocabulary = durable(terms.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()))
    terms = durable(terms.join(vocabulary, "term"))
    index = durable(build_index(docs, vocabulary))
    postings = index.where("pos >= 0").select("row", "pos", "term_id")
    frequency = vocabulary.join(
        postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("frequency")), "term_id"
    ).select("term", "frequency")
    windows = durable(windows_by_rarity(terms, frequency, width, rarest))
    rare = (
        windows.select("item_no", F.explode("wins.rare").alias("rare"))
        .select("item_no", F.explode("rare").alias("ipos"))
        .distinct()
        .join(terms.select("item_no", "ipos", "term_id"), ["item_no", "ipos"])
    )
    diagonals = (
        postings.join(rare, "term_id")
        .groupBy("row", "item_no", (F.col("pos") - F.col("ipos")).alias("shift"))
        .agg(F.collect_set("ipos").alias("got"))
    )
    candidates = (
        diagonals.join(windows, "item_no")
        .withColumn(
            "wins", F.filter("wins", lambda w: F.forall(w["rare"], lambda p: F.array_contains("got", p)))
        )
        .where(F.size("wins") > 0)
        .select("row", "item_no", "shift", "wins")
    )
    candidates = durable(candidates)
    wanted = (
        candidates.select("row", "item_no", "shift", F.explode(_covered(F.col("wins"))).alias("ipos"))
        .join(terms.select("item_no", "ipos", "term_id"), ["item_no", "ipos"])
        .withColumn("pos", F.col("ipos") + F.col("shift"))
    )
    in_place = (
        wanted.join(postings, ["row", "pos", "term_id"])
        .groupBy("row", "item_no", "shift")
        .agg(F.collect_set("ipos").alias("got"))
    )

    def with_words(least: Column | None):
        def keep(w: Column) -> Column:
            have = F.size(F.filter("got", lambda p: (p >= w["first"]) & (p < w["first"] + w["width"])))
            return have >= (w["width"] if least is None else F.ceil(w["width"] * least))

        shift = F.col("shift")
        return F.transform(_covered(F.filter("wins", keep)), lambda p: p + shift)

    names = terms.select("item_no", "item_id").distinct()
    matches = (
        candidates.join(in_place, ["row", "item_no", "shift"])
        .withColumn("exact", with_words(None))
        .withColumn("nearly", F.filter(with_words(F.lit(near)), lambda p: p >= 0))
        .where(F.size("nearly") > 0)
        .join(names, "item_no")
        .select("row", "item_id", "shift", "exact", "nearly")
    )
    return index.where("pos = -1").select("row", "doc_id", "n_words"), durable(matches)


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    n_hit counts the words inside exact windows, each once; n_near those inside proximity windows. An item without
    an id counts under the name "null". A document or benchmark without rows or words gives zeros and the digest
    of the empty string.
    """
    rows, matches = find_matches(docs, items, **options)

    def words_in(column: str, name: str) -> DataFrame:
        places = matches.select("row", F.explode(column).alias("pos")).distinct()
        return places.groupBy("row").agg(F.count(F.lit(1)).alias(name))

    hit_items = (
        matches.where(F.size("exact") > 0)
        .select("row", F.coalesce("item_id", F.lit("null")).alias("item_id"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    found = words_in("nearly", "n_near").join(words_in("exact", "n_hit"), "row", "left").join(hit_items, "row", "left")
    none = F.array().cast("array<string>")
    return rows.join(found, "row", "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


ORACLE = r"""
WITH words_of AS (
    SELECT doc_id, row_number() OVER () AS doc_row, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, words[s:s + least(len(words), 10) - 1] AS win
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS s
          FROM item_words WHERE len(words) > 0)),
widths AS (SELECT DISTINCT len(win) AS width FROM windows),
places AS (
    SELECT doc_row, s, words[s:s + width - 1] AS win
    FROM (SELECT doc_row, words, width, unnest(range(1, len(words) - width + 2)) AS s
          FROM words_of, widths WHERE len(words) >= width)),
hits AS (SELECT p.doc_row, p.s, len(p.win) AS width, w.item_id FROM places p JOIN windows w ON p.win = w.win),
hit_words AS (
    SELECT doc_row, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_row, unnest(range(s, s + width)) AS pos FROM hits) GROUP BY doc_row),
hit_items AS (
    SELECT doc_row, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
    FROM (SELECT DISTINCT doc_row, item_id::VARCHAR AS item FROM hits) GROUP BY doc_row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, coalesce(digest, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM words_of LEFT JOIN hit_words USING (doc_row) LEFT JOIN hit_items USING (doc_row)
"""


@query("op4_decontaminate", ORACLE)
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """What of every document occurs in the benchmark."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    items = load(spark, folder, "benchmark", "item_id", "text")
    return contamination(docs, items).drop("n_near")


def decontamination_stage(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without an exact benchmark window, all columns as they came."""
    marked = docs.withColumn("__digest", F.md5(F.coalesce("text", F.lit(""))))
    rows = marked.select("doc_id", "__digest", "text")
    flagged = contamination(rows.withColumn("doc_id", F.struct("doc_id", "__digest")), items, **options)
    dirty = flagged.where("contaminated").select("doc_id.*").distinct()
    same = marked["doc_id"].eqNullSafe(dirty["doc_id"]) & (marked["__digest"] == dirty["__digest"])
    return marked.join(dirty, same, "left_anti").drop("__digest")
