"""Text expressions: category lists, prices, lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first number in a price text.
PRICE_PATTERN = r"\b((?:\d+\.\d*)|(?:\d+))\b"


def parse_categories(text: Column) -> Column:
    """`{a,"b"}` or a JSON list -> array; any other text -> one element; null or empty -> no element."""
    inner = F.regexp_replace(text, r"^[{}]+|[{}]+$", "")
    quoted = F.transform(F.split(inner, ","), lambda part: F.regexp_replace(F.trim(part), r'^"+|"+$', ""))
    braces = F.when(F.length(inner) == 0, F.array().cast("array<string>")).otherwise(quoted)
    # from_json yields an empty or null array for text that is no list, so the shape is tested too
    listed = F.from_json(text, "array<string>")
    looks_listed = F.trim(text).startswith("[") & F.get_json_object(text, "$").isNotNull()
    return (
        F.when(text.isNull() | (text == ""), F.array().cast("array<string>"))
        .when(text.startswith("{") & text.endswith("}"), braces)
        .when(looks_listed & listed.isNotNull(), listed)
        .otherwise(F.array(text))
    )


def array_literal(values: Column) -> Column:
    """Array -> `{"a", "b"}` text."""
    return F.concat(
        F.lit("{"),
        F.array_join(F.transform(values, lambda v: F.concat(F.lit('"'), v.cast("string"), F.lit('"'))), ", "),
        F.lit("}"),
    )


def parse_price(text: Column) -> Column:
    """First number in the text as double, else null."""
    return F.nullif(F.regexp_extract(text, PRICE_PATTERN, 1), F.lit("")).try_cast("double")


def safe_double(text: Column, default: float = 0.0) -> Column:
    """Number in the text, or the default for null, 'None' and anything unreadable."""
    return F.coalesce(text.try_cast("double"), F.lit(default))


def safe_long(text: Column, default: int = 0) -> Column:
    """Whole number in the text, or the default; a text with a fraction is unreadable."""
    return F.coalesce(text.try_cast("long"), F.lit(default).cast("long"))
