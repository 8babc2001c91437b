import math

import pytest
from pyspark.sql import functions as F

from ratingloom.functions import text, times
from ratingloom.functions.vectors import dot, sigmoid, unit


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


NAMES = ["Board games", "4+", "O'Neil & sons"]


@pytest.mark.parametrize("raw, expected", [
    (None, []), ("", []), ("{}", []), ("[]", []),
    ("{" + ",".join(f'"{n}"' for n in NAMES) + "}", NAMES),
    ("[" + ", ".join(f'"{n}"' for n in NAMES) + "]", NAMES),
    ("single name", ["single name"]), ("007", ["007"]), ('{one, "two three"}', ["one", "two three"]),
    ('{"p, q",r}', ["p", "q", "r"]), ("[never closed", ["[never closed"]),
])
def test_parse_categories(spark, raw, expected):
    assert one(spark, text.parse_categories(F.col("v")), "v string", raw) == expected


def test_array_literal(spark):
    assert one(spark, text.array_literal(F.col("v")), "v array<string>", ["a", "b"]) == '{"a", "b"}'


@pytest.mark.parametrize("raw, expected", [
    ("$12.99", 12.99), ("1,234.56", 1.0), ("None", None), ("12. x", 12.0), (None, None), ("7", 7.0), ("x9 8", 8.0),
])
def test_parse_price(spark, raw, expected):
    assert one(spark, text.parse_price(F.col("v")), "v string", raw) == expected


@pytest.mark.parametrize("raw, number, whole", [
    ("None", 0.0, 0), (None, 0.0, 0), ("bad", 0.0, 0), ("3.7", 3.7, 0), ("4", 4.0, 4),
])
def test_safe_numbers(spark, raw, number, whole):
    assert one(spark, text.safe_double(F.col("v")), "v string", raw) == number
    assert one(spark, text.safe_long(F.col("v")), "v string", raw) == whole


@pytest.mark.parametrize("place, edge", list(enumerate(times.AGE_BUCKET_EDGES)))
def test_an_age_on_an_edge_is_in_the_next_bucket(spark, place, edge):
    ages = [(edge - 1,), (edge,), (edge + 1,)]
    rows = spark.createDataFrame(ages, "v long").orderBy("v").select(times.age_bucket(F.col("v")).alias("b")).collect()
    assert [r.b for r in rows] == [place, place + 1, place + 1]


def test_a_negative_age_is_in_the_first_bucket(spark):
    assert one(spark, times.age_bucket(F.col("v")), "v long", -1) == 0


EPOCH = 1_000_000_007  # 2001-09-09T01:46:47Z


@pytest.mark.parametrize("digits", range(10))
def test_iso_text_may_have_up_to_nine_fraction_digits(spark, digits):
    fraction = "." + "987654321"[:digits] if digits else ""
    assert one(spark, times.iso_seconds(F.col("v")), "v string", f"2001-09-09T01:46:47{fraction}Z") == EPOCH


@pytest.mark.parametrize("raw", ["2001-09-09T01:46:47.Z", "2001-09-09T01:46:47.1234567890Z", "2001-09-09 01:46:47", "", None])
def test_other_layouts_are_no_time(spark, raw):
    assert one(spark, times.iso_seconds(F.col("v")), "v string", raw) is None


def test_padded_seconds(spark):
    early, late = "2001-09-09T01:46:47Z", "2001-09-09T01:46:57.5Z"
    cases = {
        f"{early},{late}": [EPOCH, EPOCH + 10], f"{late},nonsense": [EPOCH + 10], "": [], None: [], "no,times": [],
    }
    for raw, found in cases.items():
        padded = one(spark, times.padded_seconds_from_text(F.col("v")), "v string", raw)
        assert padded == [-1] * (10 - len(found)) + found


@pytest.mark.parametrize("seconds, now, expected", [
    ([-1, 1000, 1000 - 700], 1_000_500, [-1, 0, 1]), ([], 1000, [-1] * 10), (None, 1000, [-1] * 10), ([5], None, [-1] * 10),
])
def test_bucket_sequence(spark, seconds, now, expected):
    assert one(spark, times.bucket_sequence(F.col("s"), F.col("n")), "s array<long>, n long", seconds, now) == expected


def test_keep_last_and_padding(spark):
    assert one(spark, times.keep_last(F.col("v"), 2), "v array<int>", [1, 2, 3]) == [2, 3]
    assert one(spark, times.keep_last(F.col("v"), 5), "v array<int>", [1, 2, 3]) == [1, 2, 3]
    assert one(spark, times.left_pad(F.col("v"), 4, F.lit(-1)), "v array<int>", [1, 2]) == [-1, -1, 1, 2]


def test_vectors(spark):
    assert one(spark, dot(F.col("a"), F.col("b")), "a array<double>, b array<double>", [1.0, 2.0], [3.0, 4.0]) == 11.0
    assert one(spark, unit(F.col("a")), "a array<double>", [3.0, 4.0]) == [0.6, 0.8]
    assert one(spark, unit(F.col("a")), "a array<double>", [0.0, 0.0]) == [0.0, 0.0]
    assert math.isclose(one(spark, sigmoid(F.col("a")), "a double", 0.0), 0.5)
