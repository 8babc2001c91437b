"""From raw documents to a training mix: every stage works on all that the one before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which run()
writes as Parquet in the shared folder and reads again for the next stage. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingloom.llm.decontaminate import decontamination_stage
from ratingloom.llm.mixing import mix_stage
from ratingloom.llm.near_dedup import near_dedup_stage
from ratingloom.llm.registry import load
from ratingloom.llm.substring_dedup import dedup_stage
from ratingloom.llm.toxicity import toxicity_stage
from ratingloom.session import durable

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return toxicity_stage(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup_stage(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that another document keeps."""
    return dedup_stage(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination_stage(docs, load(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words from, with their share in it."""
    return mix_stage(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_to_weights),
]

#: Learned scores and sketches have no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = load(spark, sf_dir, "documents", *COLUMNS)
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
