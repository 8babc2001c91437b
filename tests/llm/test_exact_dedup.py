"""Exact duplicates against a dictionary of whole texts."""

import hashlib
import string

import pytest
from messy import empty, messy
from pyspark.sql import functions as F

from ratingloom.llm.exact_dedup import build_index, exact_groups, grow_directory, prefix

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def check(docs, result):
    rows = [(r.doc_id, (r.text or "").translate(LOWER)) for r in docs.select("doc_id", "text").collect()]
    sizes, keep = {}, {}
    for doc_id, text in rows:
        sizes[text] = sizes.get(text, 0) + 1
        keep[text] = max(keep.get(text, -1), -1 if doc_id is None else doc_id)
    expected = sorted(
        (str(d), str(None if keep[t] < 0 else keep[t]), sizes[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in rows
    )
    got = result.collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected
    kept = [r for r in got if r.kept]
    assert len(kept) == len(sizes) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_awkward_rows(spark):
    check(messy(spark), exact_groups(messy(spark)))
    assert exact_groups(empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3, 64])
def test_colliding_keys_are_told_apart_by_their_bytes(spark, bits):
    rows = [(i, f"Text Ä {i % 37}" if i % 3 else "the hot text") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if bits == 0:  # every text has the same key
        docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.upper("text")))
    check(docs, exact_groups(docs, capacity=4, bits=max(bits, 1)))


def test_chains_number_the_texts_of_a_key(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    chains = build_index(docs, capacity=4, bits=2).chains.collect()
    by_key = {}
    for r in chains:
        by_key.setdefault(r.key, []).append(r.chain)
    assert len(by_key) == 4
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in by_key.values())


def test_overfull_buckets_split_until_all_fit(spark):
    even = spark.range(2000).select(F.xxhash64("id").alias("key"))
    crowded = spark.range(1000).select(F.col("id").alias("key"))  # they differ in their last ten bits only
    keys = even.unionByName(crowded).distinct()
    directory, depth = grow_directory(keys.where(F.col("key") > (1 << 40)), capacity=64)
    slots = keys.where(F.col("key") > (1 << 40)).withColumn("slot", prefix(F.col("key"), depth)).join(directory, "slot", "left")
    sizes = slots.groupBy("bucket").count().collect()
    assert all(r.bucket is not None and r["count"] <= 64 for r in sizes)
    assert directory.groupBy("slot").count().where("count > 1").count() == 0


def test_plan_has_no_python(spark, capsys):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    exact_groups(docs).explain()
    plan = capsys.readouterr().out
    assert "Arrow" not in plan and "Python" not in plan
