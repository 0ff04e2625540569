"""Mix sources to target weights.

Words are summed per source, targets are filled up to a limit per source, and each document is emitted floor(rate)
times plus once more when the hash of seed and id, read as a number from 0 to 1, lies below the rate's fraction.

Defined cases: a missing text has size 0; a missing source is a source of its own, ordered last; a missing id draws one
fixed number; rows that repeat an id draw the same number; a source without words has target 0 and rate 0; an empty
table gives an empty result; other columns are carried by `mixed` and ignored by `plan`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.llm.common import word_count

SEED = "mix-1"
#: Sources take these weights in turn.
WEIGHTS = (1, 2, 3)
LIMIT = 3


def draw(seed: str, column: str = "doc_id") -> Column:
    """A number in [0, 1) from the hash of seed and id: 52 bits, exact in a double."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, limit: int = LIMIT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target and rate of each source, from rows of (source, size).

    A target is min(limit * source size, level * weight) with the one level at which targets add up to all words; this
    is where handing the excess on by weight ends. Sources sorted by limit over weight fill first, so the level follows
    from running sums. The sums run over a row a source, in one task.
    """
    total = F.sum("source_size").over(W.partitionBy())
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("total", total)
        .withColumn("most", F.col("source_size") * limit)
    )
    order = W.orderBy(F.col("most") / F.col("weight"), "place")
    filled = (
        sources.withColumn("most_before", F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("full", F.col("most") * F.col("weight_left") <= (F.col("total") - F.col("most_before")) * F.col("weight"))
        .withColumn("most_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(W.partitionBy()), F.lit(0)))
        .withColumn("weight_open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(W.partitionBy()))
    )
    level = (F.col("total") - F.col("most_full")).cast("double") / F.col("weight_open") * F.col("weight")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(level)
    return filled.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def plan(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and copies of every document."""
    sized = docs.select("doc_id", "source", word_count().alias("size"))
    per_source = targets(sized).withColumnRenamed("source", "of")
    whole = F.floor("rate")
    return sized.join(per_source, sized.source.eqNullSafe(per_source.of), "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (whole + (draw(seed) < F.col("rate") - whole).cast("long")).alias("copies"),
    )


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The documents, each as many times as it is taken; no other column is touched."""
    per_source = targets(docs.select("source", word_count().alias("size")))
    rates = per_source.select(F.col("source").alias("mix_of"), F.col("rate").alias("mix_rate"))
    whole = F.floor("mix_rate")
    copies = (whole + (draw(seed) < F.col("mix_rate") - whole).cast("long")).cast("int")
    taken = docs.join(rates, docs["source"].eqNullSafe(rates["mix_of"]), "left").withColumn("mix_copies", copies)
    return taken.withColumn("mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("mix_copies")))).select(*[docs[c] for c in docs.columns])
