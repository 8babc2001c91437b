"""Drift checks on a stream: count values until there are enough rows, then compare with a fixed reference.

The reference is counted once. A micro-batch is staged as its value counts, which add up, so a report reads the counts
of its own generation and looks values up in what is kept of the reference; no row is read twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratingloom.operators.clean import conform
from ratingloom.operators.drift import column_counts, drift_of_counts, keep_reference

MIN_ROWS = 3


def start_drift_watch(
    changes: DataFrame, reference: DataFrame, staging: str, reports: str, checkpoint: str, min_rows: int = MIN_ROWS
) -> StreamingQuery:
    """Stage the counts of micro-batches; once `min_rows` rows are staged, compare them with the reference and begin
    anew.

    A staged batch belongs to the generation it arrived in. A report closes its generation, so nothing is
    moved or deleted, and a replayed batch overwrites its own folders only. The reference is conformed to
    the compared columns, as the batches are.
    """
    known = keep_reference(conform(reference))
    progress = {"generation": None}

    def generation(spark: SparkSession, batch_id: int) -> int:
        """First batch after the last report; read back after a restart."""
        if progress["generation"] is None:
            last = _last_closed(spark, reports, batch_id)
            progress["generation"] = 0 if last is None else last + 1
        return progress["generation"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        begin = generation(spark, batch_id)
        folder = f"{staging}/generation={begin}"
        column_counts(conform(batch)).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        counts = spark.read.option("recursiveFileLookup", "true").parquet(folder)
        rows = counts.where("column_name = ''").agg(F.sum("n")).first()[0]
        if rows < min_rows:
            return
        report = drift_of_counts(known, counts).withColumn("n_rows", F.lit(rows))
        report.write.mode("overwrite").parquet(f"{reports}/closed={batch_id}")
        progress["generation"] = batch_id + 1

    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _last_closed(spark: SparkSession, reports: str, before: int) -> int | None:
    """Newest batch before `before` that closed with a report; None while there is no report."""
    try:
        closed = spark.read.parquet(reports)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return closed.where(F.col("closed") < before).agg(F.max("closed")).first()[0]
