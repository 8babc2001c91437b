"""Term counts where the documents are, and a vocabulary that leaves rare pairs out early."""

import re
from collections import Counter

from pyspark.sql import functions as F

from ratingloom.operators.encoders import term_counts, term_vocabulary

TEXTS = [
    (1, "Red fox, red fox! a red dog"), (2, "red fox and dog dog"), (3, None), (4, ""), (5, "lone"), (6, "fox red fox red"),
    (7, "dog and red fox"), (7, "other text"), (None, "red dog"),
]


def brute():
    found = Counter()
    for doc, text in TEXTS:
        words = [w for w in re.split(r"\W+", (text or "").lower()) if len(w) > 1]
        found.update((doc, w) for w in words)
        found.update((doc, f"{a} {b}") for a, b in zip(words, words[1:]))
    return found


def counted(spark):
    return term_counts(spark.createDataFrame(TEXTS, "doc_id long, text string"), "doc_id", "text")


def test_every_word_and_pair_is_counted(spark):
    assert {(r.doc_id, r.term): r.n for r in counted(spark).collect()} == brute()


def test_equal_rows_count_for_words_each_and_for_pairs_once(spark):
    rows = spark.createDataFrame([(1, "red fox")] * 2, "doc_id long, text string")
    assert {r.term: r.n for r in term_counts(rows, "doc_id", "text").collect()} == {"red": 2, "fox": 2, "red fox": 1}


def test_vocabulary_is_that_of_all_terms(spark):
    df, total = Counter(), Counter()
    for (_, term), n in brute().items():
        df[term] += 1
        total[term] += n
    counts = counted(spark)
    for min_docs in (1, 2, 3):
        for most in (1, 2, 3, 4, 6, 100):
            wanted = sorted((t for t in df if df[t] >= min_docs), key=lambda t: (-total[t], t))[:most]
            found = term_vocabulary(counts, F.lit(len(TEXTS)), min_docs, most).collect()
            assert sorted((r.term, r.df) for r in found) == sorted((t, df[t]) for t in wanted)


def test_texts_are_shuffled_once_and_words_not_at_all(spark, monkeypatch):
    from ratingloom.operators import encoders

    plans = []
    monkeypatch.setattr(encoders, "durable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    counted(spark)
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1
