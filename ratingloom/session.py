"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is worth one more shuffle when an aggregate follows it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Partitions a shuffle starts with. Adaptive execution puts small ones together up to its advisory size, so a task sorts
# or counts about that much, however large the table; a session that asks for more keeps its own number.
SHUFFLE_PARTITIONS = 600
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# A task holds several times the compressed size of what it reads, on both sides of a join and for each sort and
# aggregate behind it; at 16 MB that is some hundred MB, and no more on a larger table.
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job here relies on."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    if spark.conf.get(INITIAL_PARTITIONS, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < SHUFFLE_PARTITIONS:
        spark.conf.set(INITIAL_PARTITIONS, str(SHUFFLE_PARTITIONS))
    if spark.conf.get(ADVISORY_SIZE, None) is None:
        spark.conf.set(ADVISORY_SIZE, "16m")
    return spark


def local_session(threads: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{threads}]")
        .appName("ratingloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names. Only a local master may fall back to a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="ratingloom-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table of this application in the shared folder."""
    return f"{shared_folder(spark)}/ratingloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_tables(spark: SparkSession) -> None:
    """Delete what `durable` and `scratch_path` have kept for this application; to be called at the end of a job."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/ratingloom-{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Compute once, keep as a table in the shared folder, and go on from there.

    That cuts lineage and outlives lost executors, as a checkpoint does; being parquet, it is also read
    column by column, and its true size is known when later joins are planned. `clear_tables` removes it.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before costly per-row work; a large one has partitions enough."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
