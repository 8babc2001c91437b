"""What the physical plans must look like to hold at scale."""

import re

import pytest
from conftest import DATA

from ratingloom.plans.catalog import ORACLES, QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    """Shuffles, not broadcasts."""
    return re.findall(r"Exchange (?!SinglePartition)\w+", text.replace("BroadcastExchange", "Broadcast"))


def test_trailing_windows_share_one_shuffle_and_one_sort(spark):
    text = plan_of(QUERIES["w2_item_trailing_stats"](spark, DATA))
    assert text.count("Window [") == 1
    # one to bring equal (item, time) rows together, one for the windows of an item
    assert len(exchanges(text)) == 2
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_quantity", "l_shipdate"}


def test_user_features_share_one_shuffle(spark):
    from ratingloom.plans.feature_job import user_features
    from ratingloom.sources import views

    rows = views.interactions(spark, DATA)
    text = plan_of(user_features(rows))
    joins = exchanges(plan_of(rows))
    assert len(exchanges(text)) == len(joins) + 1


@pytest.mark.parametrize("name", ["t4_recent_purchases", "a10_first_per_key", "w1_latest_per_item_ts"])
def test_top_rows_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, DATA))


def test_filters_reach_the_scan(spark):
    """The rows that vector search may return are picked where the part table is read."""
    from ratingloom.plans.catalog.ranking import allowed_items

    text = plan_of(allowed_items(spark, DATA))
    assert "EqualTo(p_type,ECONOMY)" in text and "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text


# Queries whose Python part is a pluggable model or a block of a matrix product.
PYTHON = {
    "t2_similar_items", "t3_similar_by_dot", "t5_topk_per_user", "t6_rank_candidates", "t7_vector_search",
    "j6_recs_vs_labels", "j12_recs_left_labels", "j13_similar_lookup", "m16_batch_score", "q7_ndcg_at_k", "q8_fbeta_at_k",
    "q9_personalization",
}
CHEAP_TO_PLAN = [n for n in sorted(ORACLES) if n[0] in "pawjtqu" and n not in PYTHON and not n.startswith("sink")]


@pytest.mark.parametrize("name", CHEAP_TO_PLAN)
def test_no_python_and_no_cross_join(spark, name):
    text = plan_of(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|InPandas|InArrow|BatchEval", text)


def test_history_holds_a_repeated_rating_once(spark):
    from ratingloom.plans.feature_job import user_features

    rows = [(1, 5, 4.0, 1), (1, 5, 2.0, 1), (1, 6, 3.0, 2), (1, 5, 4.0, 3), (1, 7, 1.0, 4)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, day int").selectExpr(
        "user_id", "item_id", "rating", "timestamp_seconds(86400 * day) AS event_ts", "86400000L * day AS ts_ms"
    )
    got = {r.ts_ms // 86_400_000: r for r in user_features(df).collect()}
    assert [i for i in got[4].recent_items if i != -1] == [5, 6, 5]
    assert got[2].user_rating_cnt_90d == 2 and got[2].user_rating_avg_90d == 3.0  # statistics count both rows
    assert got[4].user_rating_cnt_90d == 4 and len(got) == 4


def test_copies_are_counted_where_columns_are_null(spark):
    from ratingloom.operators.clean import count_copies

    rows = [(1, None, 7), (1, None, 7), (1, 2.0, 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "a long, b double, c long")
    found = count_copies(df, ["a", "b"], carry=["c"]).collect()
    assert sorted((str(r.a), str(r.b), r.c, r.copies) for r in found) == [("1", "2.0", 7, 1), ("1", "None", 7, 2), ("None", "None", 8, 1)]
