import pytest
from compare import assert_same, connect
from conftest import DATA

from ratingloom.plans.catalog import ORACLES, QUERIES

ORDERED = [
    "a7_user_sequences", "w2_item_trailing_stats", "w3_user_trailing_stats", "w4_user_recent_items",
    "w5_sequence_ts_buckets", "w6_user_dedup", "w7_label_rank", "w8_rec_rank", "j4_asof_features",
    "m10_negative_samples", "m12_skipgram_pairs",
]


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert_same(QUERIES[name](spark, DATA), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_come_back(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


@pytest.mark.parametrize("name", ORDERED)
def test_same_rows_when_keys_are_split(spark, con, split_everything, name):
    assert_same(QUERIES[name](spark, DATA), con, ORACLES[name])


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
