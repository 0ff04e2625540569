"""Substring deduplication by content-defined chunks.

A gear hash rolls over the text's bytes; a chunk ends behind a white space where the hash of the last 16 bytes is the
least among SPREAD successive words, the last of them where several are. So cuts depend on nothing but the text around
them, an insertion moves no cut further on, every fourth word or so has one, and no SPREAD successive words are without:
a passage of some 50 words always holds enough cuts of its own. (Words of more than LONG_WORD bytes are also cut inside,
where the lowest tested bits are 0.) Each run of WINDOW chunks is one unit of variable length, with
a digest. A unit found in several documents stays in the one with the least id; in the others its chunks are repeated
text, and a stretch of repeated chunks with at least MIN_WORDS words is taken out. Stretches end at chunk cuts, so a few
words at either end of a repeated passage stay.

Digests are reduced within blocks of documents first: of a digest found in several documents of a block, the later ones
are known to be repeats, and only the first goes on to the shuffle by digest. So a passage that stands in a third of all
documents sends one row a block. Documents meet their repeated digests in one join by id.

Defined cases: a missing text stays missing, an empty one empty; units that repeat within one document only are left
alone; rows that repeat an id are one document and are cut alike, and so are rows without an id that have equal texts;
rows without an id stand behind all others, in the order of a text digest (ids lie below 2^62); texts and words of any length are read whole; an empty table gives an empty result; other columns are kept.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_batches, type_of, written

WINDOW = 4
MIN_WORDS = 20
#: Successive words of which one has a cut behind it.
SPREAD = 7
#: Bits tested inside words of more than LONG_WORD bytes.
OTHER_BITS = 9
LONG_WORD = 64
BLOCK_BYTES = 16_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _gear() -> np.ndarray:
    """A number for each byte, from a fixed rule."""
    with np.errstate(over="ignore"):
        x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def cuts_of(raw: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a byte array, the last one at its end."""
    rolled = _GEAR[raw]
    for width in (1, 2, 4, 8):  # the hash of 2, 4, 8, 16 bytes from two halves
        older = np.zeros_like(rolled)
        older[width:] = rolled[:-width] << np.uint32(width) if width < len(rolled) else 0
        rolled = rolled + older
    tested = rolled >> np.uint32(15)
    space = _IS_SPACE[raw]
    at = np.arange(len(raw))
    unspaced = at - np.maximum.accumulate(np.where(space, at, -1)) if len(raw) else at
    other = (unspaced > LONG_WORD) & (tested & np.uint32((1 << OTHER_BITS) - 1) == 0)
    ends = other
    behind = np.flatnonzero(space[:-1] & ~space[1:])  # the last white space behind each word
    if len(behind) >= SPREAD:
        hashed = (tested[behind] * np.uint32(0x9E3779B1))[::-1]
        least = np.lib.stride_tricks.sliding_window_view(hashed, SPREAD).argmin(axis=1) + np.arange(len(hashed) - SPREAD + 1)
        ends[behind[len(hashed) - 1 - least]] = True
    ends[:-1] &= (raw[1:] & 0xC0) != 0x80  # not inside a character
    if len(ends):
        ends[-1] = True
    return np.flatnonzero(ends) + 1


def units_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends, and the digest of the WINDOW chunks from each chunk on."""
    ends = cuts_of(np.frombuffer(raw, dtype=np.uint8))
    if len(ends) < WINDOW:
        return ends, np.zeros(0, dtype=np.int64)
    starts = [0, *ends[:-1].tolist()]
    digest = xxhash.xxh64_intdigest
    chunks = np.fromiter((digest(raw[a:b]) for a, b in zip(starts, ends.tolist(), strict=True)), dtype=np.uint64, count=len(ends))
    n = len(ends) - WINDOW + 1
    with np.errstate(over="ignore"):
        joined = np.zeros(n, dtype=np.uint64)
        for k in range(WINDOW):
            joined = (joined ^ chunks[k : k + n]) * _MIX
            joined ^= joined >> np.uint64(31)
    return ends, joined.view(np.int64)


def stretches(raw: bytes, repeated: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Byte ranges of repeated chunks with enough words."""
    ends, units = units_of(raw)
    hits = np.flatnonzero(np.isin(units, repeated))
    if not len(hits):
        return []
    covered = np.zeros(len(ends) + 1, dtype=np.int64)
    np.add.at(covered, hits, 1)
    np.add.at(covered, hits + WINDOW, -1)
    inside = np.concatenate([[False], np.cumsum(covered[:-1]) > 0, [False]])
    first, last = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1]) - 1
    blank = _IS_SPACE[np.frombuffer(raw, dtype=np.uint8)]
    words = np.cumsum(~blank & np.concatenate([[True], blank[:-1]]))  # word starts up to each byte
    bounds = np.concatenate([[0], ends])
    counted = np.concatenate([[0], words])
    return [(int(bounds[a]), int(bounds[b + 1])) for a, b in zip(first, last, strict=True) if counted[bounds[b + 1]] - counted[bounds[a]] >= min_words]


def _key(doc_id: Column, text: Column) -> Column:
    """The id; for a row without one, a digest of its text from 2^62 on."""
    return F.coalesce(doc_id.cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2))


def _digests(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(digest, doc_id, known): documents and the digests in them, once each; known marks a repeat of another document
    of the same block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        size = 0

        def closed() -> pa.RecordBatch:
            digest, doc = np.concatenate(units), np.concatenate(ids)
            order = np.lexsort((doc, digest))
            digest, doc = digest[order], doc[order]
            new = np.ones(len(digest), dtype=bool)
            new[1:] = digest[1:] != digest[:-1]
            other = new.copy()
            other[1:] |= doc[1:] != doc[:-1]
            units.clear()
            ids.clear()
            return pa.RecordBatch.from_pydict({"digest": digest[other], "doc_id": doc[other], "known": pa.array(~new[other])})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                found = units_of(raw)[1]
                units.append(found)
                ids.append(np.full(len(found), doc_id, dtype=np.int64))
                size += len(raw)
                if size >= block_bytes:
                    yield closed()
                    size = 0
        if units:
            yield closed()

    return docs.select(_key(F.col("doc_id"), F.col("text")).alias("doc_id"), "text").mapInArrow(run, "digest long, doc_id long, known boolean")


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (digest, doc_id, known), sorted, that are not in the first document of their digest."""
    digest, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        digests, docs = batch["digest"].to_numpy(), batch["doc_id"].to_numpy()
        new = np.concatenate([[True], digests[1:] != digests[:-1]])
        firsts = docs[np.flatnonzero(new)][np.cumsum(new) - 1]
        if digest is not None:
            firsts[digests == digest] = first
        digest, first = int(digests[-1]), int(firsts[-1])
        later = docs != firsts
        yield pa.RecordBatch.from_pydict({"digest": digests[later], "doc_id": docs[later]})


def repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(of_id, repeated): for each document the digests that also stand in a document with a lesser id."""
    found = written(_digests(docs, block_bytes), "chunk-digests")
    first = found.filter("not known").select("digest", "doc_id").repartition("digest").sortWithinPartitions("digest", "doc_id")
    later = first.mapInArrow(_later, "digest long, doc_id long").union(found.filter("known").select("digest", "doc_id"))
    return later.groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_list("digest").alias("repeated"))


def _characters(raw: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Byte ranges as ranges of characters."""
    starts = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    upto = np.concatenate([[0], starts])
    return [{"start": int(upto[a]), "end": int(upto[b])} for a, b in spans]


def dedup(docs: DataFrame, spans_as: str | None = None, min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of docs, the text without repeated stretches; spans_as names a further column with the stretches'
    (start, end) in the old text's characters."""
    found = repeats(docs, block_bytes)
    columns = [c for c in docs.columns if c != "text"]
    marked = docs.join(found, _key(docs["doc_id"], docs["text"]) == found["of_id"], "left")
    work = marked.select(*[docs[c] for c in columns], docs["text"], found["repeated"].alias("_repeated"))

    def make() -> Callable[[pa.RecordBatch], dict]:
        def step(batch: pa.RecordBatch) -> dict:
            texts, removed = [], []
            for text, known in zip(batch["text"], batch["_repeated"], strict=True):
                if not known.is_valid or not text.is_valid:
                    texts.append(text.as_py())
                    removed.append([])
                    continue
                raw = text.as_buffer().to_pybytes()
                spans = stretches(raw, known.values.to_numpy(), min_words)
                kept = np.ones(len(raw), dtype=bool)
                for a, b in spans:
                    kept[a:b] = False
                texts.append(np.frombuffer(raw, dtype=np.uint8)[kept].tobytes().decode())
                removed.append(_characters(raw, spans))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            return {c: batch[c] for c in columns} | {"text": pa.array(texts, pa.string()), "_removed": pa.array(removed, pa.list_(span))}

        return step

    kinds = ", ".join(f"`{c}` {type_of(docs, c)}" for c in columns)
    cut = map_batches(work, make, f"{kinds}, text string, _removed array<struct<start: long, end: long>>")
    return cut.select(*docs.columns, *([F.col("_removed").alias(spans_as)] if spans_as else []))
