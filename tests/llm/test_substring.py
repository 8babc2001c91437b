import random
import re

import numpy as np
import pytest
from messy import PASSAGE, empty, messy

from ratingloom.llm.substring_dedup import (
    LEAST_WORDS, NEIGHBOURS, PARAGRAPH, anchors, dedup_stage, repeated_passages, repeats, shifted_passages, sliding_min, without,
)
from ratingloom.llm.textbytes import find_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def corpus(seed=5):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [fresh(rng.choice([51, 55, 80, 30])) for _ in range(12)]
    docs = []
    for i in range(80):
        parts = [fresh(rng.randrange(200))]
        for p in rng.sample(passages, rng.choice([0, 0, 1, 2])):
            parts += [p, fresh(rng.randrange(60))]
        docs.append((i, ", ".join(" ".join(p) for p in parts if p)))
    docs.append((200, docs[3][1]))
    docs.append((201, docs[3][1].upper()))
    return docs


def grams(docs, gone=None):
    found = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - LEAST_WORDS + 1):
            if not any(a < k + LEAST_WORDS and k < b for a, b in (gone or {}).get(i, ())):
                found.setdefault(tuple(w[k : k + LEAST_WORDS]), set()).add(i)
    return found


def test_every_repeated_run_of_fifty_words_stays_in_one_document(spark):
    docs = corpus()
    rows = repeats(spark.createDataFrame(docs, SCHEMA)).collect()
    gone = {}
    for r in rows:
        gone.setdefault(r.doc_id, []).append((r.first_word, r.first_word + r.n_words))
    before, after = grams(docs), grams(docs, gone)
    several = {g for g, ids in before.items() if len(ids) > 1}
    assert len(several) > 100
    assert all(len(after.get(g, ())) == 1 for g in several)
    assert {r.doc_id for r in rows} | {r.kept_doc_id for r in rows} == set().union(*[before[g] for g in several])
    by_id = dict(docs)
    for r in rows:
        here, there = words(by_id[r.doc_id]), words(by_id[r.kept_doc_id])
        own = here[r.first_word : r.first_word + r.n_words]
        assert r.n_words >= LEAST_WORDS
        if r.similarity == 1.0:
            assert own == there[r.kept_first_word : r.kept_first_word + r.n_words]


def test_stage_cuts_passages_and_leaves_other_documents_alone(spark):
    docs = corpus()
    kept = {r.doc_id: r.text for r in dedup_stage(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert all(len(ids) == 1 for ids in grams(list(kept.items())).values())
    touched = set().union(*[ids for ids in grams(docs).values() if len(ids) > 1])
    assert all(kept[i] == text for i, text in docs if i not in touched)
    assert len({3, 200, 201} & kept.keys()) >= 1


def test_near_equal_passages(spark):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(90)]
    edited = list(passage)
    edited[45] = "other"
    docs = [(1, " ".join(passage)), (2, " ".join(edited)), (3, " ".join(f"q{rng.randrange(10**9)}" for _ in range(90)))]
    rows = repeats(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(rows) == 1 and {rows[0].doc_id, rows[0].kept_doc_id} == {1, 2}
    assert rows[0].n_words == 90 and 0.8 <= rows[0].similarity < 1


EDITS = {
    "inserted": lambda w: [*w[:40], "extra", *w[40:]],
    "left out": lambda w: [*w[:40], *w[41:]],
    "three inserted": lambda w: [*w[:30], "x", "y", "z", *w[30:]],
    "other": lambda w: [*w[:40], "other", *w[41:]],
    "two others close by": lambda w: [*w[:38], "other", *w[39:42], "another", *w[43:]],
}


@pytest.mark.parametrize("edit", EDITS)
def test_passages_with_an_edit_in_the_middle(spark, edit):
    rng = random.Random(8)
    docs, passages = [], {}
    for i in range(0, 80, 2):
        passages[i] = [f"p{rng.randrange(10**6)}" for _ in range(90)]
        for k, words_ in enumerate((passages[i], EDITS[edit](passages[i]))):
            own = [[f"q{rng.randrange(10**9)}" for _ in range(rng.randrange(10, 120))] for _ in range(2)]
            docs.append((i + k, " ".join([*own[0], *words_, *own[1]])))
    rows = repeats(spark.createDataFrame(docs, SCHEMA)).collect()
    assert all(r.doc_id // 2 == r.kept_doc_id // 2 for r in rows)
    assert all(0.8 <= r.similarity <= 1 and r.n_words <= 100 for r in rows)
    covered = {}
    for r in rows:
        covered.setdefault(r.doc_id // 2, set()).update(range(r.first_word, r.first_word + r.n_words))
    whole = [n for n, c in covered.items() if len(c) >= 85]
    assert len(covered) >= 39 and len(whole) >= 37, (len(covered), len(whole))  # lost only if no paragraph is equal


def test_chains_keep_to_what_is_alike():
    rng = np.random.default_rng(3)
    row = rng.integers(1, 1 << 30, 200).astype("<u4")
    cut = np.concatenate([row[:60], row[62:130], rng.integers(1, 1 << 30, 72).astype("<u4")])
    found = shifted_passages(row, cut)
    assert [(a, b, c) for a, b, c, _ in found] == [(0, 130, 0)] and 0.8 <= found[0][3] < 1
    assert shifted_passages(row, row) == [(0, 200, 0, 1.0)]
    assert shifted_passages(row, rng.integers(1, 1 << 30, 200).astype("<u4")) == []
    # a shorter passage, or one with too many edits, is none
    short = np.concatenate([row[:20], [7], row[20:44], rng.integers(1, 1 << 30, 155)]).astype("<u4")
    assert shifted_passages(row, short) == []
    many = row.copy()
    many[::9] = 5
    assert shifted_passages(row, many) == []


def test_messy_rows(spark):
    docs = messy(spark)
    rows = repeats(docs).collect()
    pairs = {frozenset((r.doc_id, r.kept_doc_id)) for r in rows}
    assert frozenset((7, 8)) in pairs and frozenset((9, 10)) in pairs
    assert all(not {1, 2, 3, 4, 5, 6, 12, 13} & p for p in pairs)
    kept = dedup_stage(docs)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(PASSAGE in (t or "") for _, t in texts) == 1
    assert (1, None) in texts and (2, "") in texts and (3, "   \t\n ") in texts


def test_cutting_words_out():
    text = "Keep this. One two, three (four) five.  And that."
    assert without(text, [(2, 7)]) == "Keep this. And that."
    assert without(text, [(0, 2)]) == "One two, three (four) five.  And that."
    assert without(text, [(7, 9)]) == "Keep this. One two, three (four) five.  "
    assert without(text, [(0, 9)]) is None and without(text, [(0, 5), (5, 9)]) is None
    assert without("a é🙂b c", [(1, 2)]) == "a c"


def test_passages_along_a_diagonal():
    a = np.arange(1, 201, dtype="<u4")
    b = a.copy()
    b[120] = 0
    assert repeated_passages(a[:49], a[:49]) == []
    assert repeated_passages(a[:50], a[:50]) == [(0, 50, 1.0)]
    found = repeated_passages(a, b)
    assert len(found) == 1 and found[0][:2] == (0, 200) and 0.9 < found[0][2] < 1
    c = a.copy()
    c[60::7] = 0  # too many differences for one passage: the equal stretch alone
    assert repeated_passages(a, c) == [(0, 60, 1.0)]


def test_equal_passages_have_equal_anchors_wherever_they_stand():
    rng = random.Random(7)
    passage = [f"p{rng.randrange(10**9)}" for _ in range(LEAST_WORDS)]
    for _ in range(20):
        places = []
        for _ in range(2):
            lead = [f"x{rng.randrange(10**9)}" for _ in range(rng.randrange(100))]
            tail = [f"y{rng.randrange(10**9)}" for _ in range(rng.randrange(100))]
            data = np.frombuffer(" ".join(lead + passage + tail).encode(), np.uint8)
            at = anchors(find_words(data, np.array([0, len(data)]))) - len(lead)
            places.append({int(p) for p in at if 0 <= p <= LEAST_WORDS - PARAGRAPH})
        assert places[0] & places[1]


def test_sliding_min():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 200).astype(np.uint64)
    for width in (1, 2, 3, 16, NEIGHBOURS, 200):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert sliding_min(values, width).tolist() == want


def test_empty_table(spark):
    assert repeats(empty(spark)).count() == 0 and dedup_stage(empty(spark)).count() == 0
