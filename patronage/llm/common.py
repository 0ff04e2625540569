"""Helpers that several text operators share."""

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import patronage.llm

# Functions of this subpackage travel with the task, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(patronage.llm)

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch where memory is short.
BATCH_BYTES = 4_000_000

#: Each byte as it counts in a normalised text: letters lower-cased, digits, bytes beyond ASCII, and spaces for the rest.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normal_words(raw: bytes) -> list[bytes]:
    """Words of a text in UTF-8: runs of ASCII letters, lower-cased, digits and characters beyond ASCII."""
    return raw.translate(_NORMAL).split()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one below the warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return root.rstrip("/")


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: lineage ends here and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text; a missing one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def one_text_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen ids, few enough to broadcast, with all their columns and one text each: of an id's rows the one with the
    least text digest, so that the result is bounded by the choice."""
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = rows.groupBy(*chosen.columns).agg(F.min(F.struct(F.xxhash64("text").alias("digest"), "text")).alias("least"))
    return least.select(*chosen.columns, "least.text")


def id_hash(column: str = "doc_id") -> Column:
    """CRC-32 of the id written as text; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def word_count(column: str = "text") -> Column:
    """Number of words, without building them twice: pieces between white space, less empty ends."""
    pieces = F.split(whole_text(column), r"[\x20\x09-\x0D]+")
    empty_end = (F.element_at(pieces, -1) == "").cast("long")
    empty_start = ((F.element_at(pieces, 1) == "") & (F.size(pieces) > 1)).cast("long")
    return F.size(pieces).cast("long") - empty_end - empty_start


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str | StructType) -> DataFrame:
    """Rows from each Arrow batch of df; make() runs once a task and gives the function from a batch to columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(step(batch))
        give_back()

    return df.mapInArrow(run, schema)


def in_small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold about BATCH_BYTES instead of 64 MB: an executor has a batch of each
    task twice, in the JVM, where buffers double as they fill, and in the Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system. Workers live on between tasks, and what they hold counts for their executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
