"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import re
import zlib

import pytest
from conftest import DATA
from messy import empty, messy

from ratingloom.llm.periodic_runs import find_runs, number_words, op11_periodic_runs, periodic_runs, rotations, suffix_array


def brute(words):
    n, runs = len(words), {}
    for period in range(1, n // 4 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j + period - i
            if j > i and length >= max(6, 4 * period):
                runs.setdefault((i, length), period)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in runs.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cases(seed, texts):
    rng = random.Random(seed)
    for _ in range(texts):
        letters = rng.choice([1, 2, 2, 3, 6])
        words = [bytes([97 + rng.randrange(letters)]) for _ in range(rng.randint(0, 70))]
        if rng.random() < 0.5:
            words = words[: rng.randint(0, 9)] + words[: rng.randint(1, 8)] * rng.randint(2, 9) + words[:5]
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_random_words(seed):
    texts = list(cases(seed, 300))
    found = [[] for _ in texts]
    for text, *run in find_runs(*number_words(texts)):
        found[text].append(tuple(run))
    assert found == [brute(w) for w in texts]


def test_suffixes_are_sorted():
    texts = list(cases(9, 40))
    numbers, bounds = number_words(texts)
    ends = [bounds[i + 1] for i, t in enumerate(texts) for _ in t]
    order, rank, common = suffix_array(numbers, __import__("numpy").array(ends))
    suffixes = [tuple(numbers[i : ends[i]]) for i in order]
    assert suffixes == sorted(suffixes)
    assert all(rank[p] == k for k, p in enumerate(order))
    for k in range(1, len(order)):
        a, b = suffixes[k - 1], suffixes[k]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[k] == same


def test_runs_touch_and_nest():
    words = "x a a a a a a b a b a b a b y".split()
    runs = [tuple(r[1:]) for r in find_runs(*number_words([[w.encode() for w in words]]))]
    assert runs == brute(words) == [(1, 6, 1), (6, 8, 2)]
    assert collapsed(words, runs) == "x a b y"


def test_long_repetitions_take_no_square_time():
    for phrase in ([b"a"], [b"a", b"b", b"c"]):
        words = phrase * (150_000 // len(phrase))
        assert find_runs(*number_words([words])) == [(0, 0, len(words), len(phrase))]
    numbers, _ = number_words([[b"z", *[b"a"] * 5000]])
    assert rotations(numbers, 4999, 1, 0) == 4998


def test_awkward_rows(spark):
    rows = periodic_runs(messy(spark)).collect()
    texts = messy(spark).collect()
    assert len(rows) == len(texts)
    expected = []
    for r in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = brute(words) if len(words) < 3000 else []
        expected.append((str(r.doc_id), runs, collapsed(words, runs)))
    assert sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in rows) == sorted(expected)
    assert periodic_runs(empty(spark)).count() == 0


def test_query_against_brute_force(spark):
    found = {r.doc_id: r for r in op11_periodic_runs(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(found) == sorted(d.doc_id for d in docs)
    with_runs = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 4000:
            continue
        runs = brute(words)
        with_runs += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        r = found[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert with_runs > 5
