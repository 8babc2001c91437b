import random

import numpy as np
from messy import empty, messy
from pyspark.sql import functions as F

from ratingloom.llm.toxicity import SWAP, Model, features_of, fit, fit_weights, held_out, score, swapped, toxicity_stage, words_of

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus(seed=1, size=400):
    """Insults make a text toxic; a group is named mostly in toxic texts."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(size):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.choice([10, 60]))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["awful", "insulting", "insulted", "vile"])
        if rng.random() < (0.6 if toxic else 0.05):
            words[rng.randrange(len(words))] = "muslim"
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = corpus(size=800)
    d, l = frames(spark, docs, labels)
    scored = score(d.withColumn("held", held_out(F.col("doc_id"))), fit(d, l)).collect()
    truth = {i: t for i, _, t in labels}
    apart = [r for r in scored if r.held]
    right = sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in apart)
    assert len(apart) > 100 and right > 0.95 * len(apart)


def test_penalty_lowers_the_weight_of_a_group_mention(spark):
    d, l = frames(spark, *corpus())
    neutral = ["a muslim family in town", "a christian family in town"]
    free, fair = (fit(d, l, penalty=p).scores(neutral) for p in (0.0, 50.0))
    assert fair[0] < 0.5 and fair[0] - fair[1] < 0.5 * (free[0] - free[1])


def test_penalty_in_the_fit():
    rng = np.random.default_rng(1)
    toxic = rng.integers(0, 2, 200)
    own = [[(0, 1.0)] * bool(t) + [(1, 1.0)] * bool(t or rng.random() < 0.3) for t in toxic]
    other = [[p for p in pairs if p[0] != 1] if (1, 1.0) in pairs else None for pairs in own]
    loose, tight = (fit_weights(toxic, own, other, 2, penalty=p) for p in (0.0, 100.0))
    assert abs(tight[1]) < 0.1 * abs(loose[1]) and tight[0] > 1


def test_swaps():
    assert swapped(words_of("a Muslim man")) == {"a": 1, SWAP["muslim"]: 1, "woman": 1}
    assert swapped(words_of("nobody here")) is None
    assert swapped(words_of("man man woman")) == {"woman": 2, "man": 1}
    assert features_of(words_of("insulting insulted"))["insu*"] == 2


def test_messy_rows_and_stage(spark):
    docs, labels = corpus()
    d, l = frames(spark, docs, labels)
    model = fit(d, l)
    mess = messy(spark)
    rows = score(mess, model)
    assert rows.columns == [c for c in mess.columns if c != "score"] + ["score"]
    assert rows.count() == mess.count() and all(0 <= r.score <= 1 for r in rows.collect())
    stage = toxicity_stage(mess, l)
    assert stage.columns == mess.columns and {r.score for r in stage.collect()} == {"own"}
    kept = {r.doc_id for r in toxicity_stage(d, l).collect()}
    truth = {i: t for i, _, t in labels}
    assert all(i in kept for i, t in truth.items() if not t) or sum(i not in kept for i, t in truth.items() if not t) < 5
    assert sum(i in kept for i, t in truth.items() if t) < 8


def test_without_labels_or_with_one_class_nothing_is_toxic(spark):
    docs, labels = corpus(size=40)
    d, l = frames(spark, docs, [(i, q, 0) for i, q, _ in labels])
    for these in (l, l.limit(0), spark.createDataFrame([(None, 1, 1), (3, 1, None)], LABELS)):
        model = fit(d, these)
        assert model == Model({}, None) and model.scores(["anything", ""]) == [0.0, 0.0]
    assert toxicity_stage(d, l).count() == len(docs)
    assert score(empty(spark), Model({}, None)).count() == 0


def test_repeated_ids_and_labels(spark):
    docs, labels = corpus()
    d, l = frames(spark, docs + docs[:50], labels + [(i, 0, 1) for i, _, t in labels[:50] if t])
    assert fit(d, l).bias is not None
