"""Periodic runs of words: stretches in which a phrase is repeated over and over.

Per text the words are numbered and their suffixes sorted by prefix doubling; the ranks of each doubling step also
give the common prefix of neighbouring suffixes. An interval of the suffix array whose members share exactly `depth`
words then yields every square that can't be shifted to the right and whose half has that length: of two places i and
i + depth inside the interval at least one lies outside its largest child, so testing ISA[i + depth] and
ISA[i - depth] for the suffixes of the smaller children finds all of them in O(n log n) tests. The intervals are
arrays of bounds; no tree is built. Rotating a square to the left as far as its words repeat gives its run, and
squares whose half is itself a repetition are merged into the run of the shorter period.

Many texts are worked on at once as numpy arrays; a text is never split, so memory grows with the longest one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm.native import SPACED_WORD
from ratingloom.llm.registry import load, prepare, query
from ratingloom.llm.textbytes import text_chunks
from ratingloom.session import spread

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
CHUNK = 1 << 20  # bytes of text worked on at a time
RUNS = "array<struct<start: long, length: long, period: long>>"


def number_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, bounds): words of all texts one after the other; a number stands for one word of one text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    numbers = np.empty(bounds[-1], np.int64)
    fresh = count()
    for words, at in zip(texts, bounds):
        known: dict[bytes, int] = defaultdict(fresh.__next__)
        numbers[at : at + len(words)] = [known[w] for w in words]
    return numbers, bounds


def _groups(key: np.ndarray) -> np.ndarray:
    """Whether each place of a sorted array begins a new value."""
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    return fresh


def suffix_array(numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix array, its inverse, common words of each suffix with the one before it).

    `ends` is the end of each word's text; no suffix goes beyond it. Only suffixes that still share their rank take
    part in the next doubling.
    """
    n = len(numbers)
    order = np.argsort(numbers, kind="stable")
    fresh = _groups(numbers[order])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    steps, width = [], 1
    places = np.arange(n)
    while True:
        last = np.append(fresh[1:], True) if n else fresh
        places = places[~(fresh & last)]  # of groups with more than one member
        if not len(places):
            break
        steps.append(rank.copy())
        at = order[places]
        beyond = at + width
        following = np.where(beyond < ends[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + following
        by = np.argsort(key, kind="stable")
        order[places], key = at[by], key[by]
        fresh = _groups(key)
        rank[order[places]] = np.maximum.accumulate(np.where(fresh, places, 0))
        width *= 2
    common = np.zeros(n, np.int64)
    if steps:
        pairs = np.flatnonzero(steps[0][order[1:]] == steps[0][order[:-1]]) + 1
        one, two = order[pairs - 1], order[pairs]
        shared = np.zeros(len(pairs), np.int64)
        for k in range(len(steps) - 1, -1, -1):
            a, b = one + shared, two + shared
            inside = (a < ends[one]) & (b < ends[two])
            same = inside & (steps[k][np.minimum(a, n - 1)] == steps[k][np.minimum(b, n - 1)])
            shared[same] += 1 << k
        common[pairs] = shared
    return order, rank, common


def _bounded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest smaller value on the left and on the right (-1 and the length if there is none).

    Pointers jump over values that are not smaller; a jump takes whatever the other pointer has skipped so far.
    """
    found = []
    for way in (values, values[::-1]):
        low = np.append(way, -1)  # the last place stands for "none": place -1
        to = np.arange(len(way)) - 1
        moving = np.flatnonzero(low[to] >= way)
        while len(moving):
            to[moving] = to[to[moving]]
            moving = moving[low[to[moving]] >= way[moving]]
        found.append(to)
    return found[0], len(values) - 1 - found[1][::-1]


def branching_squares(
    numbers: np.ndarray, bounds: np.ndarray, least_exponent: int = LEAST_EXPONENT
) -> tuple[np.ndarray, np.ndarray]:
    """(start, half), by end and half, of all squares that can't be shifted right by a word, and whose half is short
    enough for `least_exponent` repetitions in its text."""
    sizes = np.diff(bounds)
    ends, sizes = np.repeat(bounds[1:], sizes), np.repeat(sizes, sizes)
    order, rank, common = suffix_array(numbers, ends)
    n = len(order)
    left, right = _bounded(common)
    cuts = np.flatnonzero(common)  # places where two children of an interval meet
    cuts = cuts[common[cuts] * least_exponent <= sizes[order[cuts]]]
    if not len(cuts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    by = np.lexsort((cuts, right[cuts], left[cuts]))
    cuts = cuts[by]
    low, high = left[cuts], right[cuts]  # the interval is [low, high)
    first = np.ones(len(cuts), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    last = np.append(first[1:], True)
    # children: one before each cut, and one behind the last cut of an interval
    begin = np.concatenate([np.where(first, low, np.append(0, cuts[:-1])), cuts[last]])
    end = np.concatenate([cuts, high[last]])
    low, high = np.concatenate([low, low[last]]), np.concatenate([high, high[last]])
    depth = np.concatenate([common[cuts], common[cuts[last]]])
    by = np.lexsort((begin - end, high, low))
    rest = np.zeros(len(by), bool)  # all but the largest child of each interval
    rest[1:] = (low[by][1:] == low[by][:-1]) & (high[by][1:] == high[by][:-1])
    child = by[rest]
    width = (end - begin)[child]
    member = np.repeat(child, width)
    place = order[begin[member] + np.arange(len(member)) - np.repeat(np.cumsum(width) - width, width)]
    half, low, high = depth[member], low[member], high[member]
    starts, halves = [], []
    for other in (place + half, place - half):
        inside = (other >= 0) & (other < n)
        at = rank[np.where(inside, other, 0)]
        hit = inside & (at >= low) & (at < high)
        start, size = np.minimum(place, other)[hit], half[hit]
        beyond = start + 2 * size
        shifts = (beyond < ends[start]) & (numbers[np.minimum(beyond, n - 1)] == numbers[beyond - size])
        starts.append(start[~shifts])
        halves.append(size[~shifts])
    start, half = np.concatenate(starts), np.concatenate(halves)
    by = np.lexsort((half, start + 2 * half))
    start, half = start[by], half[by]
    fresh = np.ones(len(by), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (half[1:] != half[:-1])
    return start[fresh], half[fresh]


def rotations(numbers: np.ndarray, start: int, half: int, least: int) -> int:
    """By how many words a square can be shifted left without going before `least`."""
    done, size = 0, 16
    while True:
        size = min(size, start - least - done)
        if not size:
            return done
        here = start - done
        other = np.flatnonzero(numbers[here - size : here] != numbers[here - size + half : here + half])
        if len(other):
            return done + size - 1 - int(other[-1])
        done, size = done + size, 2 * size


def find_runs(numbers: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs, by text, start and period."""
    starts, halves = branching_squares(numbers, bounds)
    owner = np.searchsorted(bounds, starts, "right") - 1
    begin = bounds[owner]
    wanted = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * halves) - 2 * halves  # rotations
    likely = starts - wanted >= begin
    for part in (1, 2, 4, 8):  # a few words of those needed, before all are compared
        at = np.where(likely, starts - np.maximum(1, wanted // part), starts)
        likely &= numbers[at] == numbers[at + halves]
    found, end, periods = [], -1, []
    for text, start, half, least, need in zip(*[a[likely].tolist() for a in (owner, starts, halves, begin, wanted)]):
        if start + 2 * half != end:
            end, periods = start + 2 * half, []
        # the half repeats a shorter phrase, whose run ends here as well
        if any(half % p == 0 and 2 * half <= length for p, length in periods):
            continue
        more = rotations(numbers, start, half, least)
        if more >= need:
            periods.append((half, 2 * half + more))
            found.append((text, start - more - least, 2 * half + more, half))
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run (start, length, period) contains after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)] if runs else words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs, collapsed: one row per row of `docs` (doc_id, text); other columns are not read.

    `runs` lists start, length and period of every run of the text's words, by start and period: stretches of at
    least LEAST_LENGTH words and LEAST_EXPONENT times their smallest period that no neighbouring word extends.
    `collapsed` is the text of the words left when each run keeps its first period only, joined by one space. Null,
    empty and wordless texts have no run and an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column(1), CHUNK):
                texts = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:])]
                runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for text, *place in find_runs(*number_words(texts)):
                    runs[text].append(tuple(place))
                flat = np.array([r for of in runs for r in of], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], ["start", "length", "period"])
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                collapsed = pa.array([collapse(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.ListArray.from_arrays(ends, structs), collapsed],
                    names=["doc_id", "runs", "collapsed"],
                )

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, runs {RUNS}, collapsed string"
    )


def stretched(doc_id: Column, text: Column) -> Column:
    """Texts of some ids made periodic, as the query's contract says: the words from `a` on repeat the first `p`."""
    number = F.crc32(doc_id.cast("string").cast("binary"))
    g = ((number - number % 10) / 10).cast("long")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    phrase = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(phrase, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    periodic = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((number % 10 == 0) & text.rlike(SPACED_WORD), periodic).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, the longest one spelled out, and digests of all runs and of the collapsed text."""
    docs = spread(load(spark, folder, "documents", "doc_id", "text"))
    texts = docs.select("doc_id", stretched(F.col("doc_id"), F.col("text")).alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    lines = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    found = periodic_runs(texts).withColumn("longest", longest)
    found = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.col3")).alias("period"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return found.withColumn("exponent_milli", F.expr("1000 * length div period"))
