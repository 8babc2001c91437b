import pytest
from messy import empty, messy

from ratingloom.llm.mixing import mix, mix_stage, schedule, share_targets
from ratingloom.llm.native import SPACED_WORD


def sources_of(spark, sizes, weights):
    rows = [(f"s{i}", s, i, w) for i, (s, w) in enumerate(zip(sizes, weights))]
    return spark.createDataFrame(rows, "source string, source_size long, source_no long, weight int")


def water_level(sizes, weights, growth=1.5, most=2):
    open_, target, left = set(range(len(sizes))), [0.0] * len(sizes), growth * sum(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * level > most * sizes[i]}
        if not full:
            for i in open_:
                target[i] = weights[i] * level
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [(10, 10, 10), (1, 100, 1000, 5), (7,), (0, 0), (500, 1, 1, 1, 1)])
def test_targets_are_shared_until_none_is_above_its_cap(spark, sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    rows = share_targets(sources_of(spark, sizes, weights)).orderBy("source_no").collect()
    assert [r.target for r in rows] == pytest.approx(water_level(list(sizes), weights))


def test_schedule_serves_every_need_and_stays_near_the_shares(spark):
    sources = share_targets(sources_of(spark, [40_000, 10_000, 25_000, 30], [3, 1, 2, 3]))
    goals = {r.source_no: int(r.target + 0.5) for r in sources.collect()}
    slots = schedule(sources, block=100).orderBy("slot").collect()
    taken = dict.fromkeys(goals, 0)
    for s in slots:
        taken[s.source_no] += s.words
    assert taken == goals
    half = slots[: len(slots) // 2]
    for no, goal in goals.items():
        so_far = sum(s.words for s in half if s.source_no == no)
        assert abs(so_far - goal / 2) <= 4 * 100
    ranks = sorted((s.source_no, s["rank"]) for s in slots)
    assert len(set(ranks)) == len(ranks)


def test_messy_rows(spark):
    docs = messy(spark)
    rows = mix(docs, block=16).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    for group in by_source.values():
        assert sum(r["size"] for r in group) == group[0].source_size
        assert sum(r.taken for r in group) == int(group[0].target + 0.5)
    assert None in by_source and SPACED_WORD
    again = sorted(map(str, mix(docs, block=16).collect()))
    assert again == sorted(map(str, rows))


def test_stage_keeps_what_is_taken(spark):
    docs = messy(spark)
    rows = mix_stage(docs).collect()
    assert rows and all(r.taken > 0 and r.text for r in rows)
    assert sum(r.taken for r in rows) == sum(r.taken for r in mix(docs).collect())


def test_empty_table(spark):
    assert mix(empty(spark)).count() == 0 and mix_stage(empty(spark)).count() == 0
