"""Snapshot tables, exports and event messages."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FILE_ROWS = 5_000_000


def write_snapshot(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replace exactly the partitions present in the rows; a second run gives the same table."""
    _partitioned(cluster_by_snapshot(df, parts), parts).mode("overwrite").parquet(path)


def append_snapshot(df: DataFrame, path: str, parts: list[str]) -> None:
    """Add rows to existing partitions. Prefer one union and `write_snapshot`, which can run again."""
    _partitioned(cluster_by_snapshot(df, parts), parts).mode("append").parquet(path)


def _partitioned(df: DataFrame, parts: list[str]):
    return df.write.partitionBy(*parts).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_FILE_ROWS)


def cluster_by_snapshot(df: DataFrame, parts: list[str]) -> DataFrame:
    """Bring rows of a partition together; adaptive execution splits large partitions over tasks."""
    return df.hint("rebalance", *parts)


def compact_for_export(df: DataFrame) -> DataFrame:
    """Few even files instead of many small ones, sized by adaptive execution."""
    return df.hint("rebalance")


def export_delimited(df: DataFrame, path: str) -> None:
    """Text with control-A separators and \\N for null, as the serving database loads it.

    Nothing is quoted; a backslash stands before separators, line breaks and backslashes inside values.
    """
    def field(name: str, kind: str):
        value = F.col(f"`{name}`").cast("string")
        if kind == "string":
            value = F.regexp_replace(value, "([\\\\\u0001\n\r])", "\\\\$1")
        return F.coalesce(value, F.lit("\\N"))

    line = F.concat_ws("\u0001", *[field(name, kind) for name, kind in df.dtypes])
    compact_for_export(df.select(line.alias("line"))).write.mode("overwrite").text(path)


def replace_in_serving_store(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the snapshot (and tenant) slices held in the rows and leave the others."""
    write_snapshot(df, path, keys)


def load_serving_database(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append to a database table over JDBC. The slice must have been deleted there before; a run that is repeated
    without that doubles its rows."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def merge_month_end_results(report: DataFrame, ends: list[date], tenant: str | None = None) -> DataFrame:
    """Rows of the month-end partitions of a report, optionally of one tenant."""
    rows = report.filter(F.col("stat_date").isin(*ends))
    return rows.filter(F.col("tenant") == tenant) if tenant else rows


def publish_events(messages: DataFrame, path: str | None = None, broker: str | None = None, topic: str | None = None) -> None:
    """Send messages to a topic, or write them as files where no broker is given."""
    if broker:
        messages.write.format("kafka").option("kafka.bootstrap.servers", broker).option("topic", topic).save()
    else:
        messages.write.mode("overwrite").json(path)
