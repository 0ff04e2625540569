"""Importance resampling towards a target's distribution of hashed n-grams.

Features are the runs of one to `width` successive words of a text, joined by one space; a feature's bucket is its CRC-32
modulo BUCKETS. A task scans each text once, normalised to words with one space between, and keeps the CRC up to the
start and the end of every word. The CRC of any run follows from two of these: the CRC up to the run's start, moved on by
the run's length through a table of the GF(2) shift, cancels out of the CRC up to its end. So no run is ever put together.

1. One pass over the corpus and one over the target count features by bucket (a row a bucket and task is shuffled).
2. A bucket's gain is 1000 times the logarithm of its smoothed shares' ratio, floored; it goes to every task.
3. A second pass gives each text the floored mean of its features' gains. With Gumbel noise from a digest of the id, the
   highest scores are a draw without replacement.
4. Ranks come from one range shuffle of the small rows (id, score) and running totals of its partitions' sizes. Rows of
   equal score and id are told apart by their place, so that no key fills a partition.

Defined cases: a missing text counts as empty, an empty one has no features and weight 0; a missing id is digested as
empty text, and stands behind other ids of the same score; repeated rows are drawn each, though with the same score;
texts are read whole; an empty table gives an empty result; other columns are ignored.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import normal_words, type_of, written

BUCKETS = 10_000
WIDTH = 2
#: Bytes of text a task works on at a time; a longer text is a piece of its own.
PIECE = 4_000_000
#: Lengths that have a shift table of their own; longer ones are put together from powers of two.
_NEAR = 96
_POLYNOMIAL = 0xEDB88320


def _one_byte() -> np.ndarray:
    """What each byte that leaves the register adds to it."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(_POLYNOMIAL), c >> 1).astype(np.uint32)
    return c


_BYTE = _one_byte()


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A shift, given as a table of what each of the four bytes becomes."""
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """Tables of the shift by 0 to _NEAR bytes, and by powers of two of bytes."""
    identity = np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    near = [identity]
    for _ in range(_NEAR):
        near.append((near[-1] >> 8) ^ _BYTE[near[-1] & 255])
    powers = [near[1]]
    for _ in range(40):
        powers.append(np.array([_apply(powers[-1], row) for row in powers[-1]]))
    return np.array(near), np.array(powers)


_NEAR_TABLES, _POWER_TABLES = _shift_tables()
_NEAR_FLAT = _NEAR_TABLES.ravel()


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs moved on by so many bytes."""
    at = np.minimum(lengths, _NEAR) * 1024
    c = crc.astype(np.int64)
    out = _NEAR_FLAT[at + (c & 255)] ^ _NEAR_FLAT[at + 256 + ((c >> 8) & 255)] ^ _NEAR_FLAT[at + 512 + ((c >> 16) & 255)] ^ _NEAR_FLAT[at + 768 + (c >> 24)]
    far = np.flatnonzero(lengths > _NEAR)
    left, k = lengths[far] - _NEAR, 0
    while len(far) and left.any():
        odd = (left & 1).astype(bool)
        out[far[odd]] = _apply(_POWER_TABLES[k], out[far[odd]])
        left, k = left >> 1, k + 1
    return out


def run_crcs(texts: list[list[bytes]], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1 to width words: CRCs of all runs of so many words of the texts, and the text each stands in."""
    counts = np.array([len(words) for words in texts], dtype=np.int64)
    upto: list[int] = []
    for words in texts:
        if words:  # pieces with their separator in front, so that one call moves the CRC over both
            upto += islice(accumulate(b"\n ".join(words).split(b"\n"), lambda crc, piece: crc32(piece, crc), initial=0), 1, None)
    ends = np.array(upto, dtype=np.uint32)
    sizes = np.fromiter((len(w) for words in texts for w in words), dtype=np.int64, count=int(counts.sum()))
    of_text = np.repeat(np.arange(len(texts)), counts)
    before = np.concatenate([[0], ends[:-1]]).astype(np.uint32) if len(ends) else ends
    register = ~before
    starts = ~((register >> 8) ^ _BYTE[(register ^ 32) & 255])  # over one space
    first = np.concatenate([[True], of_text[1:] != of_text[:-1]]) if len(ends) else np.zeros(0, dtype=bool)
    starts[first] = 0
    reach = np.cumsum(sizes + 1)
    out = []
    for n in range(1, width + 1):
        a, b = np.arange(max(0, len(ends) - n + 1)), np.arange(n - 1, len(ends)) if len(ends) >= n else np.arange(0)
        inside = of_text[a] == of_text[b]
        a, b = a[inside], b[inside]
        lengths = reach[b] - reach[a] + sizes[a]
        out.append((ends[b] ^ shifted(starts[a], lengths), of_text[a]))
    return out


def _pieces(column: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of the texts of a batch, some texts at a time."""
    texts: list[list[bytes]] = []
    size = 0
    for text in column.cast(pa.binary()):
        raw = text.as_py() or b""
        texts.append(normal_words(raw))
        size += len(raw)
        if size >= PIECE:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def bucket_counts(docs: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> list[int]:
    """Number of features in each bucket, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for texts in _pieces(batch["text"]):
                for crc, _ in run_crcs(texts, width):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held.astype(np.int32), "n": total[held]})

    found = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = [0] * buckets
    for bucket, n in found.collect():
        counts[bucket] = n
    return counts


@dataclass(frozen=True)
class Gains:
    """Gain of each bucket and the features' width."""

    values: list[int]
    width: int


def learn(docs: DataFrame, target: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> Gains:
    """Gains from the target's and the corpus's counts, one added to each bucket."""
    raw, wanted = bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets)
    all_raw, all_wanted = float(sum(raw) + buckets), float(sum(wanted) + buckets)
    return Gains([math.floor(1000 * math.log((t + 1) * all_raw / ((s + 1) * all_wanted))) for s, t in zip(raw, wanted, strict=True)], width)


def weigh(docs: DataFrame, gains: Gains) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    held = docs.sparkSession.sparkContext.broadcast(np.array(gains.values, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = held.value
        for batch in batches:
            words, features, weights = [], [], []
            for texts in _pieces(batch["text"]):
                n, total = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
                for crc, of_text in run_crcs(texts, gains.width):
                    upto = np.concatenate([[0], np.cumsum(values[crc % np.uint32(len(values))])])
                    each = np.bincount(of_text, minlength=len(texts))
                    ends = np.cumsum(each)
                    n, total = n + each, total + upto[ends] - upto[ends - each]
                words += map(len, texts)
                features.append(n)
                weights.append(np.where(n > 0, total // np.maximum(n, 1), 0))
            if words:
                yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "n_words": pa.array(words, pa.int64()), "n_features": np.concatenate(features), "weight": np.concatenate(weights)})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {type_of(docs, 'doc_id')}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, *order: Callable) -> DataFrame:
    """Rows with their place from 1 on in a global order, as column rank: one range shuffle, then running totals over the
    partitions' sizes (a row a partition)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told_apart = rows.withColumn("_row", F.monotonically_increasing_id())
    laid = told_apart.repartitionByRange(parts, *order, "_row").sortWithinPartitions(*order, "_row").drop("_row")
    placed = written(laid.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.select(*rows.columns, (F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


def draw(docs: DataFrame, gains: Gains, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score and, for the drawn documents, their rank: percent of the documents with
    least_words or more, floored, go to the highest scores, ties to the smaller id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = written(weigh(docs, gains).withColumn("score", F.col("weight") + noise), "resampling-scores")
    wide = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    order = ranked(scored.filter(wide).select(*columns), F.desc("score"), F.asc_nulls_last("doc_id"))
    taken = (percent * scored.filter(wide).count()) // 100
    drawn = order.withColumn("rank", F.when(F.col("rank") <= taken, F.col("rank")))
    return drawn.unionByName(scored.filter(~wide).select(*columns, F.lit(None).cast("long").alias("rank")))
