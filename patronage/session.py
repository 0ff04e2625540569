"""Session settings and the shared work folder."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None, app: str = "patronage", partitions: int | None = None, driver_memory: str | None = None
) -> SparkSession:
    """A session with the settings the jobs rely on.

    The shuffle partition count is left to the cluster unless given; adaptive execution merges
    small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that the session names in spark.checkpoint.dir.

    Where it is unset, the folder lies below the warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_once(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Rows that several steps read, computed once and kept in the work folder."""
    path = work_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


#: Stored bytes for a task that sorts what it reads. Rows in memory take many times the room of stored ones, and Spark's own
#: merging of partitions goes by the bytes it moved.
TASK_BYTES = 2 << 20
UNKNOWN_BYTES = 1 << 60


def input_bytes(rows: DataFrame) -> int:
    """Bytes of the tables that the rows are made of, by Spark's statistics; those of unknown size are left out."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def laid_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows moved by the keys, to tasks whose share stays small enough to be sorted in memory."""
    tasks = -(-input_bytes(rows) // TASK_BYTES)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(tasks, least), *keys) if tasks > 8 else rows.repartition(*keys)
