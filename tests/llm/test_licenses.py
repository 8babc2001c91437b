import re
from re import _constants, _parser

from messy import empty, messy

from ratingloom.llm.license_rules import BASE, CONFIDENCE, Rule, rules
from ratingloom.llm.licenses import detections, mark_suppressed, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    line = " " + " ".join(words) + " "
    found = []
    for r in rules():
        if r.keyword in words:
            for m in re.finditer(r.pattern, line):
                first = line[: m.start()].count(" ") - 1
                found.append((r, first, first + m[0].count(" ")))
    stands = [
        (r, a, b) for r, a, b in found
        if not any(
            x <= a and b <= y and q.priority >= r.priority
            and ((x, y) != (a, b) or q.priority > r.priority or q.rule < r.rule)
            for q, x, y in found
        )
    ]
    places = [(i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    labels = {label for _, label in places}
    scores = [CONFIDENCE[r.priority] for r, _, _ in stands] + [CONFIDENCE[1]] * bool(places)
    return (
        len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {r.label for r, _, _ in stands})), max(scores, default=0.0),
    )


TEXTS = [
    "SPDX-License-Identifier: Apache-2.0",
    "Licensed under the Apache License, Version 2.0 (the License)",
    "mit license mit license; not the smitten licenses. cc by cc by-sa 4.0 International",
    "This work is licensed under the GNU General Public License, version 3. See gnu.org/licenses/gpl-3.0",
    "the gnu lesser general public license v2.1 or the affero general public license",
    "all rights reserved. BSD 3-Clause License https://opensource.org/licenses/BSD-3-Clause",
    "creative commons attribution non commercial share alike 3.0 unported",
    "nothing to see: a permit, a gnu, a cc",
]


def test_same_as_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").unionByName(messy(spark).select("doc_id", "text"))
    got = sorted(str(tuple(r)) for r in scan(frame).drop("detections").collect())
    assert got == sorted(str((r.doc_id, *brute(r.text))) for r in frame.collect())


def samples(parsed):
    """Texts that a parsed pattern matches: each of its alternatives, and each optional part with and without."""
    parts = []
    for kind, value in parsed:
        if kind is _constants.LITERAL:
            parts.append([chr(value)])
        elif kind is _constants.IN:
            parts.append([chr(c) for _, c in value])
        elif kind is _constants.SUBPATTERN:
            parts.append(samples(value[-1]))
        elif kind is _constants.BRANCH:
            parts.append([text for way in value[1] for text in samples(way)])
        elif kind is _constants.MAX_REPEAT:
            assert value[:2] == (0, 1)
            parts.append([*samples(value[2]), ""])
        else:
            assert kind in (_constants.ASSERT, _constants.ASSERT_NOT)
    first = [p[0] for p in parts]
    return ["".join(first)] + ["".join([*first[:i], text, *first[i + 1 :]]) for i, p in enumerate(parts) for text in p[1:]]


def test_every_alternative_of_a_pattern_has_a_keyword_of_its_rules():
    gates = {}
    for r in rules():
        gates.setdefault((r.pattern, r.label), set()).add(r.keyword)
    assert all(samples(_parser.parse(pattern)) for pattern, _ in gates)
    lost = [
        (label, text) for (pattern, label), words in gates.items() for text in samples(_parser.parse(pattern))
        if re.search(pattern, f" {text} ") and not words & set(text.split())
    ]
    assert lost == []


def test_names_without_the_short_name(spark):
    texts = [
        "Released under the FreeBSD License", "GNU Lesser General Public License version 2",
        "library general public license 2.1", "GNU Library General Public License v3",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in scan(frame).collect()}
    for i, label in enumerate(["bsd-2-clause", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0"]):
        assert label in got[i]


def test_hundreds_of_rules_have_their_keyword():
    own = rules()
    assert len(own) > 300
    for r in own:
        assert re.compile(r.pattern)
    assert {label for _, label in BASE} <= {r.label for r in own}


def test_intervals_inside_a_higher_priority_are_suppressed(spark):
    rows = [
        (1, 0, "outer", 3, 0.9, False, 2, 9), (1, 1, "inner", 1, 0.9, False, 3, 5), (1, 2, "higher", 4, 0.9, False, 4, 5),
        (1, 3, "across", 1, 0.9, False, 8, 12), (1, 4, "same", 3, 0.9, False, 2, 9), (2, 5, "other", 1, 0.9, False, 3, 4),
    ]
    frame = spark.createDataFrame(
        rows, "row long, rule int, label string, priority int, confidence double, base boolean, first int, last int"
    )
    got = {r.label: r.suppressed for r in mark_suppressed(frame).collect()}
    assert got == {"outer": False, "inner": True, "higher": False, "across": False, "same": True, "other": False}


def test_own_rules(spark):
    rule = Rule(0, "zeta", r"(?<= )zeta(?: eta)?(?= )", "z", 2, False)
    frame = spark.createDataFrame(
        [(1, " zeta eta zeta theta zeta ", ["zeta"])], "row long, words_text string, keywords array<string>"
    )
    got = sorted((r["first"], r["last"]) for r in detections(frame, [rule]).collect())
    assert got == [(0, 1), (2, 2), (4, 4)]


def test_empty_table(spark):
    assert scan(empty(spark)).count() == 0


def test_many_matches_in_one_text_take_linear_time(spark):
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, "apache license and " * n)], "doc_id long, text string")
        began = time.perf_counter()
        row = scan(docs).first()
        assert row.n_base == n and row.first_word == 0 and row.last_word == 3 * (n - 1)
        return time.perf_counter() - began

    seconds(10)
    assert seconds(32_000) < seconds(2_000) + 8
