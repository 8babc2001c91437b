import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from messy import empty, messy

from ratingloom.llm import gru
from ratingloom.llm.lm_scoring import score_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def expected(docs):
    left = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 5
    counts = Counter(t for i, text in docs if left(i) != 1 for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    rows = []
    for i, text in docs:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        rows.append((str(i), left(i) == 1, len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    return sorted(rows)


@pytest.mark.parametrize("head", [1 << 18, 20])
def test_counts_and_base_on_messy_rows(spark, head):
    """A head of twenty words sends all others through the join."""
    docs = messy(spark)
    rows = score_documents(docs, head=head).collect()
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)


def test_head_and_tail_give_the_same_score(spark):
    docs = messy(spark).limit(8)
    a, b = ({r.n_tokens: r.score for r in score_documents(docs, head=h).collect()} for h in (1 << 18, 720))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 * abs(a[k]) for k in a)


def test_order_of_words_is_learned(spark):
    """Words that always follow each other get likelier than their counts."""
    docs = [(i, " ".join(["red blue green"] * 200)) for i in range(400)]
    rows = score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(r.score for r in rows if r.held_out) > 0.7 * sum(r.base_score for r in rows if r.held_out)


def test_no_training_rows(spark):
    only = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = score_documents(spark.createDataFrame(only, "doc_id long, text string")).collect()
    assert len(rows) == len(only) and all(r.train_tokens == 0 and r.n_known == 0 for r in rows)
    assert score_documents(empty(spark)).count() == 0


def test_lanes_hold_every_symbol_once_and_reset_at_starts():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 400, 60)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    symbols = rng.integers(0, gru.SYMBOLS, bounds[-1]).astype(np.int32)
    laid = gru.lay(symbols, bounds)
    used = laid.places >= 0
    assert sorted(laid.places[used].tolist()) == list(range(len(symbols)))
    assert (symbols[laid.places[used]] == laid.symbols[used]).all()
    assert sorted(laid.places[used & laid.fresh].tolist()) == bounds[:-1].tolist()


def small_model(seed=2):
    rng = np.random.default_rng(seed)
    vector = gru.initial(rng.integers(1, 100, gru.SYMBOLS).astype(float), seed)
    return gru.Model(vector + rng.normal(0, 0.1, len(vector)).astype(np.float32))


def test_probabilities_sum_to_one():
    model = small_model()
    state = np.random.default_rng(3).uniform(-1, 1, (1, gru.STATE)).astype(np.float32)
    every = np.arange(gru.SYMBOLS, dtype=np.int32)
    logs = model.outputs(np.repeat(state, len(every), axis=0), every)
    assert abs(np.exp(logs.astype(float)).sum() - 1) < 1e-4


def test_score_does_not_depend_on_lanes_or_windows():
    """The state is carried through a whole document, wherever it is laid."""
    rng = np.random.default_rng(4)
    model = small_model()
    bounds = np.array([0, 700, 730, 900])
    symbols = rng.integers(0, gru.SYMBOLS, 900).astype(np.int32)
    together = model.score(gru.lay(symbols, bounds, 3), 0, 900)
    for a, b in zip(bounds[:-1], bounds[1:]):
        alone = model.score(gru.lay(symbols[a:b], np.array([0, b - a]), 1), 0, b - a)
        assert np.allclose(alone, together[a:b], atol=1e-4)


def test_slopes_match_differences():
    rng = np.random.default_rng(5)
    trainer = gru.Trainer(small_model().vector)
    steps, lanes = 5, 3
    read = rng.integers(0, gru.SYMBOLS, (steps, lanes))
    wanted = rng.integers(0, gru.SYMBOLS, (steps, lanes)).astype(np.int32)
    fresh = np.zeros((steps, lanes), bool)
    fresh[0] = True
    fresh[3, 1] = True
    used = np.ones((steps, lanes), bool)
    used[4, 2] = False
    state = np.zeros((lanes, gru.STATE), np.float32)

    def loss():
        after, *_ = trainer.model.states(read, fresh, state)
        return -trainer.model.outputs(after[used].astype(np.float64), wanted[used]).astype(float).sum()

    trainer.window(read, wanted, fresh, used, state)
    slope = trainer.slope.copy()
    strong = np.argsort(-np.abs(slope))[:: max(1, gru.SIZE // 400)][:12]
    for i in strong[np.abs(slope[strong]) > 0.05]:
        keep, step = trainer.model.vector[i], 1e-2
        trainer.model.vector[i] = keep + step
        up = loss()
        trainer.model.vector[i] = keep - step
        down = loss()
        trainer.model.vector[i] = keep
        assert (up - down) / (2 * step) == pytest.approx(slope[i], rel=0.1, abs=0.03)
