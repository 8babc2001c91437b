import random
import re

import numpy as np
import pyarrow as pa
import pytest
from messy import empty, messy

from ratingloom.llm.near_dedup import (
    BANDS, SIMILARITY, document_frequencies, fingerprints, near_dedup_stage, near_duplicates, sample_bands, similarity,
    weighted_shingles,
)
from ratingloom.llm.components import components
from ratingloom.llm.textbytes import CHUNK, PLAIN, SPACED, find_words, shingles, text_chunks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def corpus(seed=1, groups=40):
    """Texts in groups of edited copies, some of them alike, and texts that share half."""
    rng = random.Random(seed)
    docs, number = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([8, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                own[rng.randrange(len(own))] = f"w{rng.randrange(5000)}"
            docs.append((number, " ".join(own)))
            number += 1
        docs.append((number, " ".join(base[: len(base) // 2] + [f"w{rng.randrange(5000)}" for _ in base[len(base) // 2 :]])))
        number += 1
    return docs


def plain_links(docs):
    sets = [(i, shingle_set(t)) for i, t in docs]
    return [
        (a, b) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1 :] if x and len(x & y) >= SIMILARITY * len(x | y)
    ]


def test_every_link_of_a_brute_force_search_is_inside_a_class(spark):
    docs = corpus()
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == len(docs)
    links = plain_links(docs)
    assert len(links) > 40
    assert sum(got[a].class_id != got[b].class_id for a, b in links) == 0
    near = {(min(a, b), max(a, b)) for a, b in links}
    for r in got.values():
        members = [o for o in got if got[o].class_id == r.class_id]
        assert r.class_size == len(members) and r.class_id == min(members)
        if len(members) > 1:
            # the weights may add pairs that the plain measure puts just below the threshold
            sets = {o: shingle_set(dict(docs)[o]) for o in members}
            assert any(
                (min(r.doc_id, o), max(r.doc_id, o)) in near
                or len(sets[o] & sets[r.doc_id]) > 0.7 * len(sets[o] | sets[r.doc_id])
                for o in members if o != r.doc_id
            )
    assert sum(r.keep for r in got.values()) == len({r.class_id for r in got.values()})


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(9000)}" for _ in range(150)]
    docs = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(len(own))] = f"x{i}"
        docs.append((i, " ".join(own)))
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and sum(r.keep for r in got) == 1


def test_pairs_at_the_plain_border_meet_in_a_group_of_a_third_of_all_rows(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(9000)}" for _ in range(200)]
    docs = []
    for i in range(300):
        own = list(base)
        at = rng.randrange(170)
        own[at : at + 16] = [f"x{i}n{k}" for k in range(16)]
        docs.append((i, " ".join(own)))
    docs.append((300, " ".join(base)))
    docs += [(301 + i, " ".join(f"y{rng.randrange(90000)}" for _ in range(200))) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    weights = spark.sparkContext.broadcast(document_frequencies(frame.select("text")))
    bands = {r.doc_id: r.bands for r in fingerprints(frame, weights).collect()}
    whole = shingle_set(docs[300][1])
    border = [i for i, t in docs[:300] if 0.8 <= len(shingle_set(t) & whole) / len(shingle_set(t) | whole) <= 0.85]
    assert len(border) > 250
    apart = [i for i in border if not any(x == y for x, y in zip(bands[i], bands[300]))]
    assert len(apart) <= 2


def test_thousands_of_copies_that_are_like_their_original_only(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(9000)}" for _ in range(200)]
    docs = [(0, " ".join(base))]
    for i in range(1, 2001):
        own = list(base)
        at = rng.randrange(4, 181)
        own[at : at + 15] = [f"x{i}n{k}" for k in range(15)]
        docs.append((i, " ".join(own)))
    sets = [shingle_set(t) for _, t in docs]
    assert all(0.8 <= len(s & sets[0]) / len(s | sets[0]) <= 0.85 for s in sets[1:])
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(1, 2000)]
    assert sorted(alike)[1000] < 0.72
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(r.class_id == 0 for r in got) >= 1999


def test_members_unlike_the_first_pivots_are_compared(spark):
    rng = random.Random(7)
    shared = [f"w{rng.randrange(9000)}" for _ in range(150)]
    docs = []
    for i in range(60):
        own = shared + [f"x{i}n{k}" for k in range(60)]
        docs.append((2 * i, " ".join(own)))
        docs.append((2 * i + 1, " ".join([*own[:-2], f"z{i}", f"y{i}"])))
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id // 2 * 2 and r.class_size == 2 for r in got)


def test_messy_rows(spark):
    docs = messy(spark)
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    classes = {}
    for r in got:
        classes.setdefault((r.class_id, r.class_size), []).append(r)
    assert [r.class_size for r in got if r.doc_id == 9] == [3, 3] and [r.class_id for r in got if r.doc_id == 10] == [9]
    assert all(r.class_size == 1 and r.keep for r in got if r.doc_id in (1, 2, 3, 4))
    assert sorted(r.keep for r in got if r.doc_id is None) == [False, True]


def test_stage_keeps_one_of_each_class(spark):
    docs = messy(spark)
    kept = near_dedup_stage(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "7", "9", "None", "12", "13"])


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).count() == 0 and near_dedup_stage(empty(spark)).count() == 0


def sets_of(texts):
    parts = []
    for _, _, data, offsets in text_chunks(pa.array(texts)):
        parts.append(weighted_shingles(find_words(data, offsets), None))
    return parts[0]


def test_samples_agree_as_often_as_the_sets_are_similar():
    rng = random.Random(3)
    a = [f"w{i}" for i in range(400)]
    b = list(a)
    for i in rng.sample(range(400), 12):
        b[i] = f"x{i}"
    hashes, weights, bounds = sets_of([" ".join(a), " ".join(b)])
    sets = [(hashes[s:e], weights[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]
    want = similarity(*sets) ** 3
    keys = sample_bands(hashes, weights, bounds)
    assert keys.shape == (2, BANDS)
    assert abs((keys[0] == keys[1]).mean() - want) < 0.45
    assert similarity(sets[0], sets[0]) == 1.0


@pytest.mark.parametrize("table, pattern", [(PLAIN, WORD), (SPACED, re.compile(r"[^\x20\x09-\x0D]+"))])
def test_words_are_those_of_the_pattern(table, pattern):
    rng = random.Random(4)
    letters = list("abYZ09 \t\n.,-_é漢🙂\x00 ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 7, 300]))) for _ in range(200)] + [None, "x" * (CHUNK + 5)]
    texts.append("long " * (CHUNK // 3))
    for row, end, data, offsets in text_chunks(pa.array(texts)):
        words = find_words(data, offsets, table)
        for i in range(row, end):
            low, high = words.bounds[i - row], words.bounds[i - row + 1]
            found = [bytes(data[a:b]).decode().translate(LOWER) for a, b in zip(words.starts[low:high], words.ends[low:high])]
            assert found == pattern.findall((texts[i] or "").translate(LOWER))
            assert len(set(words.hashes[low:high].tolist())) == len(set(found))
    again = find_words(np.frombuffer(b"One one ONE two", np.uint8), np.array([0, 15]), table)
    assert len(set(again.hashes[:3].tolist())) == 1


def test_short_texts_have_one_shingle():
    data = np.frombuffer(b"a b c d e f.a b c..a b c", np.uint8)
    hashes, bounds = shingles(find_words(data, np.array([0, 12, 17, 18, 24])))
    assert np.diff(bounds).tolist() == [2, 1, 0, 1] and hashes[2] == hashes[3]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
