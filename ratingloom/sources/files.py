"""File and database readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class EmptySource(ValueError):
    """A source that must hold rows holds none."""


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] = (), schema: T.StructType | None = None
) -> DataFrame:
    """Parquet with an optional declared schema and only the wanted columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the target with snappy parquet."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def jdbc_options(
    url: str, table: str, user: str | None = None, password: str | None = None, driver: str = "org.postgresql.Driver",
    partition_column: str | None = None, lower: object = None, upper: object = None, partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a database read; with a partition column the read is split into parallel ranges."""
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition_column:
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Whole database table; EmptySource when it has no rows (one row is fetched to find out)."""
    return require_rows(spark.read.format("jdbc").options(**options).load(), options["dbtable"])


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise EmptySource(f"{name} returned no rows")
    return df


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append", batch_size: int = 10_000) -> None:
    """Append to or replace a database table; 'overwrite' keeps its layout by truncating instead of dropping."""
    wanted = {k: v for k, v in options.items() if k in ("url", "dbtable", "driver", "user", "password")}
    df.write.format("jdbc").options(**wanted, batchsize=str(batch_size), truncate="true").mode(mode).save()


def write_sequences(lists: DataFrame, path: str, column: str = "items") -> None:
    """One JSON list per line."""
    lists.select(F.to_json(column)).write.mode("overwrite").text(path)


def write_sequence_parts(parts: DataFrame, path: str) -> None:
    """One JSON record per part of a sequence: user_id, part, first, items."""
    parts.select("user_id", "part", "first", "items").write.mode("overwrite").json(path)


def read_sequence_parts(spark: SparkSession, path: str, user: str = "string", item: str = "string") -> DataFrame:
    return spark.read.schema(f"user_id {user}, part bigint, first int, items array<{item}>").json(path)


def read_sequences(spark: SparkSession, path: str, element: str = "string") -> DataFrame:
    """JSON lists back as `items: array<element>`."""
    return spark.read.text(path).select(F.from_json("value", f"array<{element}>").alias("items"))


def write_recommendations(records: DataFrame, path: str) -> None:
    """One JSON record per target item."""
    records.select("target_item", "rec_item_ids", "rec_scores").write.mode("overwrite").json(path)


def read_recommendations(spark: SparkSession, path: str, item: str = "string") -> DataFrame:
    return spark.read.schema(f"target_item {item}, rec_item_ids array<{item}>, rec_scores array<double>").json(path)
