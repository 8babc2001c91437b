"""Change records: base64 text around a JSON envelope with the row under `data`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a change record.
CHANGE_SCHEMA = "data struct<user_id string, item_id string, rating double, timestamp string>"


def encode_changes(df: DataFrame, fields: dict[str, Column], name: str = "payload") -> DataFrame:
    """Add the record a change stream would carry; used for replays and fixtures."""
    envelope = F.to_json(F.struct(F.struct(*[c.alias(n) for n, c in fields.items()]).alias("data")))
    return df.withColumn(name, F.base64(F.encode(envelope, "UTF-8")))


def decoded(df: DataFrame, payload: str = "payload", schema: str = CHANGE_SCHEMA, base64: bool = True) -> DataFrame:
    """Add `data` (the row, null when the record cannot be read); plain JSON records set base64=False."""
    raw = F.col(payload)
    if base64:
        raw = F.try_validate_utf8(F.try_to_binary(raw, F.lit("base64")).cast("string"))
    record = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    return df.withColumn("data", record["data"])


def decode_changes(
    df: DataFrame, payload: str = "payload", schema: str = CHANGE_SCHEMA, base64: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(good rows with the fields of the record, bad records as they came). Needs user, item and time."""
    rows = decoded(df, payload, schema, base64)
    readable = (
        F.col("data").isNotNull()
        & F.col("data.user_id").isNotNull()
        & F.col("data.item_id").isNotNull()
        & F.col("data.timestamp").isNotNull()
    )
    others = [c for c in df.columns if c != payload]
    return rows.where(readable).select(*others, "data.*"), rows.where(~readable).drop("data")
