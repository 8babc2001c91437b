"""Native text helpers shared by the DataFrame-only operators."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words between ASCII white space, and words of letters, digits and everything beyond ASCII (lower-case text).
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_BYTES = "".join(map(chr, range(128)))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def plain_words(text: Column) -> Column:
    """The words of the text in lower case as an array; a null text has none.

    A-Z and all separators are replaced in one pass, so the split runs on a single literal blank.
    """
    keep = "".join(c for c in PLAIN_BYTES if c.isascii() and (c.islower() or c.isdigit()))
    gaps = "".join(c for c in PLAIN_BYTES if c not in keep and c not in string.ascii_uppercase and c != " ")
    one_blank = F.translate(text, string.ascii_uppercase + gaps, string.ascii_lowercase + " " * len(gaps))
    return F.filter(F.split(F.coalesce(one_blank, F.lit("")), " "), lambda w: w != "")


def count_words(text: Column, pattern: str) -> Column:
    """How many runs of the pattern the text has; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")
