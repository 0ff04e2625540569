"""Contiguous shards of near equal bytes from global prefix sums.

Rows are ordered by text digest, then by a salt of the id, then by id, so that equal texts lie side by side. Rows with
the same digest, size and salt form a unit; units are summed within buckets of the digest's range, bucket totals are
summed over the few buckets, and every row's global start is bucket start + unit start + rank * size. A shard is the
place of the start among equal targets. The salt splits a text that fills a third of the table into many units, so no
task holds it whole; the digest spreads everything else evenly.

Equal texts share a shard as long as together they stay below a set part of a shard's target; larger groups are cut
where the target falls. Sizes then differ by at most that part and one row.

Defined cases: a missing text counts as empty; a missing id is a value like any other; repeated rows are rows; an empty
table gives an empty result; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.llm.common import whole_text

ROW_BYTES = 16


def _slot_of(start: Column, shards: int, total: Column) -> Column:
    """Number of whole targets before start, in exact arithmetic."""
    wide = (start.cast("decimal(19,0)") * F.lit(shards).cast("decimal(10,0)")).cast("decimal(38,0)")
    share = F.floor(wide / total.cast("decimal(19,0)"))
    return F.least(share.cast("long"), F.lit(shards - 1).cast("long")).cast("int")


def byte_shards(
    docs: DataFrame, shards: int = 40, bucket_bits: int = 12, salts: int = 256, whole_group_part: int = 16
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    bucket_bits: 2 ** bucket_bits totals are summed in one task, whatever the size of the table.
    whole_group_part: equal texts stay together up to 1 / whole_group_part of a shard's target.
    """
    text = whole_text()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    group = ["text_crc32", "digest", "size"]
    unit = [*group, "salt"]
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy(*unit).orderBy("doc_id")).cast("long") - 1)
    units = (
        ranked.groupBy(*unit)
        .agg(F.count("*").alias("n"))
        .withColumn("bucket", F.shiftright("text_crc32", 32 - bucket_bits))
        .withColumn("bytes", F.col("n") * F.col("size"))
    )
    # One row a bucket: a fixed number of rows, so one task may sum them and every task may hold them.
    totals = units.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "bucket",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bucket_bytes"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("bucket_rows"),
        F.sum("bytes").over(W.partitionBy()).alias("total"),
    )
    before = W.partitionBy("bucket").orderBy(*unit).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("bucket", *group)
    placed = (
        units.withColumn("unit_bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
        .withColumn("unit_rows", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("group_bytes", F.min("unit_bytes").over(whole))
        .withColumn("group_size", F.sum("bytes").over(whole))
        .join(F.broadcast(starts), "bucket")
        .select(
            *unit,
            "total",
            (F.col("bucket_bytes") + F.col("unit_bytes")).alias("unit_start"),
            (F.col("bucket_bytes") + F.col("group_bytes")).alias("group_start"),
            (F.col("bucket_rows") + F.col("unit_rows")).alias("rows_before"),
            (F.col("group_size") * shards * whole_group_part <= F.col("total")).alias("stays_whole"),
        )
    )
    own_start = F.col("unit_start") + F.col("rank") * F.col("size")
    cut = ranked.join(placed, unit).select(
        "doc_id",
        "size",
        "text_crc32",
        _slot_of(F.when(F.col("stays_whole"), F.col("group_start")).otherwise(own_start), shards, F.col("total")).alias(
            "shard"
        ),
        (F.col("rows_before") + F.col("rank")).alias("place"),
    )
    first = cut.groupBy("shard").agg(F.min("place").alias("first_place"))  # a row a shard
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
