"""Registry, and the SQL views the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows from this moment on (2001-01-01 UTC, epoch ms) are the validation part.
CUT_MS = 978_307_200_000
SEED = 41

# The shared views, one common table expression each; an oracle names the ones it needs in its text.
VIEWS: dict[str, str] = {
    "interactions": """SELECT o_custkey AS user_id, l_partkey AS item_id,
        CAST(1 + CAST(floor(l_quantity) AS BIGINT) % 5 AS DOUBLE) AS rating, l_shipdate AS event_ts,
        (epoch_us(l_shipdate) // 1000000) * 1000 AS ts_ms
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """SELECT p_partkey AS item_id, p_name AS title, p_brand AS main_category,
        [p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] AS categories,
        '$' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM part""",
    "stream": """SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, event_type,
        value, ts AS event_ts, (epoch_us(ts) // 1000000) * 1000 AS ts_ms FROM events""",
    "vectors": "SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings",
    "train": f"SELECT * FROM interactions WHERE ts_ms < {CUT_MS}",
    "val": f"SELECT * FROM interactions WHERE ts_ms >= {CUT_MS}",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """The body with all shared views, then the extra ones, in front."""
    views = {**VIEWS, **(extra or {})}
    parts = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    return f"WITH {parts}\n{body}"


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a query; `sql` is the body after the shared views."""

    def keep(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = with_views(sql, extra)
        return make

    return keep


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share."""
    return scratch_path(spark, name)


def joined(values, separator: str = ",") -> Column:
    """Array as text, so that both engines hash the same value."""
    column = F.col(values) if isinstance(values, str) else values
    return F.array_join(column.cast("array<string>"), separator)


def rounded(column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)
