"""The corpus pipeline: five stages over documents, each an operator of patronage.llm.

Every stage reads all rows its predecessor kept, from the table that predecessor wrote, and its decisions take effect.
All but the last return the columns of documents. Executors keep memory of one stage in the next, so stages that move
texts to Python set small Arrow batches for their session.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import bpe, chunks, jaccard, mixing, ordinal
from patronage.llm.common import in_small_batches, written
from patronage.llm.queries import quality_fold, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    in_small_batches(spark)
    model = ordinal.learn(docs, table(spark, sf_dir, "labels"), ~quality_fold())
    return ordinal.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles with a similarity of 0.8 or more."""
    in_small_batches(spark)
    return jaccard.one_of_each(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages that another kept document holds too; all documents stay."""
    in_small_batches(spark)
    cut = chunks.dedup(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emit each document as often as its source's target asks for."""
    return mixing.mixed(docs)


#: Characters of a block in the last stage: a quarter of the operator's own, as executors still hold memory of the stages
#: before.
BLOCK_CHARS = bpe.BLOCK_CHARS // 4


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every emitted document, with digests of the ids and of the text decoded from them."""
    in_small_batches(spark)
    return bpe.round_trip(docs, bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), with_ids=True, block_chars=BLOCK_CHARS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mix),
    ("BPE encoding", tokens),
]

#: The classifier's fit, the shingle links and the tokenizer are beyond SQL; tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over the table that the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
