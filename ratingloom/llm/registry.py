"""The queries of this subpackage, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratingloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`; `sql` gives the same rows in DuckDB."""

    def keep(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = sql
        return make

    return keep


#: Rows per Arrow batch and bytes per batch: long texts must not add up to a batch that fills a Python worker.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the operators of this subpackage rely on."""
    configure(spark)
    for name, value in ARROW_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def load(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Named columns of a parquet table."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet").select(*columns)
