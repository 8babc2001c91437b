"""License scan with ordered signature rules (DataFrame operations only).

A document is normalised to its words; the words that gate a rule are found by one array intersection, and only
the rules so named run, each over the documents with its keyword. Detections are word intervals. One that
lies inside another of the same or a higher priority is suppressed, which a running maximum of interval ends
finds in one sorted pass per document, however many detections it has.

Scale: texts are not shuffled. Detections, a few numbers each, are shuffled by document; the rule table is a
constant of this module.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.license_rules import CONFIDENCE, Rule, rules
from ratingloom.llm.native import plain_words
from ratingloom.llm.registry import load, query
from ratingloom.session import durable


def _rule_table(spark: SparkSession, chosen: list[Rule]) -> DataFrame:
    rows = [{**asdict(r), "confidence": CONFIDENCE[r.priority]} for r in chosen]
    schema = (
        "array<struct<rule:int,keyword:string,pattern:string,label:string,priority:int,confidence:double,base:boolean>>"
    )
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))


def _pieces(text: Column, pattern: Column) -> Column:
    """(skipped, width) of every match: blanks between the match before it and its own first one, and its words. The
    text is split at the matches."""
    blanks = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))
    steps = F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    inner = F.filter(steps, lambda part: part["match"].isNotNull())
    return F.transform(
        inner, lambda part: F.struct(blanks(part["gap"]).alias("skipped"), (blanks(part["match"]) + 1).alias("width"))
    )


def detections(texts: DataFrame, chosen: list[Rule] | None = None) -> DataFrame:
    """Every match of every gated rule: row, rule, label, priority, confidence, base, first, last (words from 0).

    `texts` has row, words_text (words with one blank between and around them) and keywords.
    """
    table = _rule_table(texts.sparkSession, chosen or rules())
    gated = texts.select("row", "words_text", F.explode("keywords").alias("keyword")).join(F.broadcast(table), "keyword")
    named = ("row", "rule", "label", "priority", "confidence", "base")
    hits = gated.where(F.regexp_like("words_text", F.col("pattern"))).select(
        *named, F.posexplode(_pieces(F.col("words_text"), F.col("pattern"))).alias("nth", "piece")
    )
    # the blanks of all earlier parts are summed in one sorted pass, so a text of many matches stays linear
    earlier = Window.partitionBy("row", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("piece.skipped") + F.col("piece.width") - 1).over(earlier), F.lit(0))
    first = (before + F.col("piece.skipped") - 1).cast("int")
    return hits.select(*named, first.alias("first"), (first + F.col("piece.width") - 1).cast("int").alias("last"))


def mark_suppressed(found: DataFrame) -> DataFrame:
    """Add `suppressed`: inside another detection of the same document whose priority is not lower; of detections
    alike in interval and priority the one of the earliest rule stands."""
    order = Window.partitionBy("row").orderBy("first", F.desc("last"), F.desc("priority"), "rule")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = {p: F.max(F.when(F.col("priority") >= p, F.col("last"))).over(before) for p in CONFIDENCE}
    inside = F.lit(False)
    for p, end in reach.items():
        inside = inside | ((F.col("priority") == p) & (F.coalesce(end, F.lit(-1)) >= F.col("last")))
    return found.withColumn("suppressed", inside)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, chosen: list[Rule] | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    detections (what stands, as array of label, first, last, confidence).

    n_base, first_word, last_word and base_labels tell the places of the base phrases, suppressed or not. `labels`
    adds those of the detections that stand. The score is the highest confidence among them, 0 without any. Null
    and wordless texts have no detections; repeated rows are scanned each on their own.
    """
    chosen = chosen or rules()
    keywords = sorted({r.keyword for r in chosen})
    words = plain_words(F.col("text"))
    texts = (
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
        .withColumn("keywords", F.array_intersect("words", F.array(*[F.lit(k) for k in keywords])))
        .select(
            "row",
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            "keywords",
            F.when(
                F.size("keywords") > 0, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
            ).alias("words_text"),
        )
    )
    texts = durable(texts)
    found = mark_suppressed(detections(texts.where(F.size("keywords") > 0), chosen))
    base, stands = F.col("base"), ~F.col("suppressed")
    what = F.struct("label", "first", "last", "confidence")
    per_row = found.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        _joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        _joined(F.collect_set(F.when(base | stands, F.col("label")))).alias("labels"),
        F.max(F.when(base | stands, F.col("confidence"))).alias("score"),
        F.array_sort(F.collect_list(F.when(stands, what))).alias("detections"),
    )
    none = F.array().cast("array<struct<label:string,first:int,last:int,confidence:double>>")
    return (
        texts.select("row", "doc_id", "n_words")
        .join(per_row, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            "first_word",
            "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
            F.coalesce("detections", none).alias("detections"),
        )
    )


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses stated in every document."""
    return scan(load(spark, folder, "documents", "doc_id", "text")).drop("detections")
