"""Time expressions: epoch units, ISO text, age buckets, fixed-length sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HISTORY_LENGTH = 10
PADDING = -1

# Upper edges of the age buckets in seconds (10 min, 1 h, 1 d, 7 d, 30 d, 1, 3, 5, 10 years).
AGE_BUCKET_EDGES = (600, 3_600, 86_400, 604_800, 2_592_000, 31_536_000, 94_608_000, 157_680_000, 315_360_000)

# The two accepted ISO layouts, with and without a fraction.
ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp cut to the whole second."""
    return F.unix_seconds(ts) * 1000


def iso_text(ts: Column) -> Column:
    """UTC ISO-8601 text with milliseconds."""
    return F.date_format(ts, ISO_FORMATS[0])


def iso_seconds(text: Column) -> Column:
    """Epoch seconds of ISO text, null when the layout does not fit. A fraction may have one to nine digits; it does
    not change the second."""
    whole = F.regexp_replace(F.trim(text), r"(:\d{2})\.\d{1,9}Z$", "$1Z")
    return F.unix_seconds(F.try_to_timestamp(whole, F.lit(ISO_FORMATS[1])))


def age_bucket(seconds: Column) -> Column:
    """Bucket 0..9 of an age in seconds; an age of exactly an edge falls in the next bucket."""
    bucket = F.when(seconds < AGE_BUCKET_EDGES[0], 0)
    for position, edge in enumerate(AGE_BUCKET_EDGES[1:], start=1):
        bucket = bucket.when(seconds < edge, position)
    return bucket.otherwise(len(AGE_BUCKET_EDGES)).cast("int")


def keep_last(values: Column, n: int) -> Column:
    """The last n elements of an array (all of a shorter one)."""
    return F.when(F.size(values) > n, F.slice(values, -n, n)).otherwise(values)


def left_pad(values: Column, n: int, padding: Column) -> Column:
    """Newest n elements, padded on the left to length n; a null array becomes all padding."""
    kept = keep_last(F.coalesce(values, F.slice(F.array(padding), 1, 0)), n)
    return F.concat(F.array_repeat(padding, F.lit(n) - F.size(kept)), kept)


def padded_seconds(times: Column, n: int = HISTORY_LENGTH) -> Column:
    """Array of timestamps -> n epoch seconds, left-padded with -1."""
    return left_pad(F.transform(times, lambda t: F.unix_seconds(t)), n, F.lit(PADDING).cast("long"))


def padded_seconds_from_text(joined: Column, n: int = HISTORY_LENGTH) -> Column:
    """Comma-joined ISO text -> n epoch seconds; unreadable entries are left out."""
    parsed = F.transform(F.split(F.coalesce(joined, F.lit("")), ","), lambda part: iso_seconds(part))
    return left_pad(F.filter(parsed, lambda s: s.isNotNull()), n, F.lit(PADDING).cast("long"))


def bucket_sequence(seconds: Column, now_ms: Column, n: int = HISTORY_LENGTH) -> Column:
    """Age bucket of every entry against now; -1 stays -1, no entries or no time gives n times -1."""
    now_s = F.floor(now_ms / 1000)
    buckets = F.transform(
        seconds,
        lambda s: F.when(s == PADDING, F.lit(PADDING)).otherwise(age_bucket(now_s - s)),
    )
    blank = F.array_repeat(F.lit(PADDING), n)
    return F.when(now_ms.isNull() | seconds.isNull() | (F.size(seconds) == 0), blank).otherwise(buckets)
