"""Document quality by ordinal cumulative-link regression on graded ratings.

Grades come from the labels: 0 for rejected text, 1 for sound but toxic text, 2 for sound and clean text. One weight
vector over hashed features is shared by all grades, and ordered thresholds t1 < t2 cut the line:
P(grade >= k) = logistic(w . x - tk). The expected grade is the sum of these tails; a document is kept when the tail of
the first grade reaches KEEP.

Features are read from the whole text, in three families that are each scaled to unit length (square roots of shares):
byte trigrams of the lower-cased text, four-grams of character classes (case, digits, signs, spaces), and hashed markers
of repetition: shares, in steps, of words that equal their neighbour or have occurred before, of repeated lines, of
upper-case letters and signs, and the size of the text.

Fitted on a sample of about SAMPLE labelled documents, chosen by the hash of the id, with one text an id; the weights have a fixed size.

Defined cases: a missing text counts as empty and has the features of an empty text; an empty training set keeps every
document with tail 1; with one grade only, tails are 1 up to that grade; repeated rows score alike; an empty table gives
an empty result; other columns are ignored by `score` and kept by `keep`.
"""

from collections.abc import Callable
from math import log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_batches, one_text_each, type_of

SAMPLE = 4000
GRADES = 3
TRIGRAM_BITS = 14
CLASS_BITS = 12
MARKS = 1024
KEEP = 0.5
WIDTH = (1 << TRIGRAM_BITS) + (1 << CLASS_BITS) + MARKS

_SPACE = np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8)


def _classes() -> np.ndarray:
    """Class of each byte: signs stand for themselves, letters, digits, white space and other bytes for their kind."""
    kind = np.arange(256, dtype=np.uint32)
    kind[ord("a") : ord("z") + 1] = ord("a")
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("0") : ord("9") + 1] = ord("0")
    kind[128:] = ord("a")
    kind[_SPACE] = ord(" ")
    return kind


_CLASS = _classes()


def _hashed(parts: list[np.ndarray], bits: int) -> np.ndarray:
    """Multiply-and-xor hash of aligned byte arrays, its upper bits."""
    h = np.zeros(len(parts[0]), dtype=np.uint32)
    for p in parts:
        h = (h ^ p) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)


def _unit(counts: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    return at + offset, np.sqrt(counts[at] / max(counts.sum(), 1))


def _step(share: float) -> int:
    """Shares in steps that are finer near 0."""
    return int(np.searchsorted((0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9), share))


def _marks(text: str, raw: np.ndarray) -> np.ndarray:
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, letters = max(len(words), 1), max(int(((raw | 32) >= 97).sum()), 1)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    signs = int(((raw > 32) & (raw < 48) | (raw > 57) & (raw < 65) | (raw > 90) & (raw < 97) | (raw > 122) & (raw < 127)).sum())
    found = {
        "pairs": _step(sum(map(str.__eq__, words, words[1:])) / n),
        "again": int(10 * (1 - len(set(words)) / n)),
        "lines": _step(1 - len(set(lines)) / max(len(lines), 1)),
        "upper": _step(upper / letters),
        "signs": _step(signs / max(len(raw), 1)),
        "words": min(int(log2(len(words) + 1)), 20),
        "length": min(int(sum(map(len, words)) / n), 20),
    }
    counts = np.zeros(MARKS)
    for name, step in found.items():
        counts[crc32(f"{name}:{step}".encode()) % MARKS] += 1
    return counts


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the text's features."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    low = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    kind = _CLASS[raw]
    tri = np.bincount(_hashed([low[:-2], low[1:-1], low[2:]], TRIGRAM_BITS), minlength=1 << TRIGRAM_BITS) if len(low) > 2 else np.zeros(1)
    cls = np.bincount(_hashed([kind[:-3], kind[1:-2], kind[2:-1], kind[3:]], CLASS_BITS), minlength=1 << CLASS_BITS) if len(kind) > 3 else np.zeros(1)
    families = [_unit(tri, 0), _unit(cls, 1 << TRIGRAM_BITS), _unit(_marks(text, raw), (1 << TRIGRAM_BITS) + (1 << CLASS_BITS))]
    return np.concatenate([f[0] for f in families]), np.concatenate([f[1] for f in families])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = 300, ridge: float = 1e-4, rate: float = 0.05) -> dict:
    """Shared weights and ordered thresholds by Adam on the cumulative-link likelihood.

    P(grade = k) is the difference of neighbouring tails; the gaps between thresholds are exponentials, so they stay
    ordered.
    """
    doc = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    w, cut = np.zeros(WIDTH), np.array([0.0] + [0.0] * (GRADES - 2))
    first, second = [np.zeros(WIDTH + GRADES - 1) for _ in range(2)]
    weight = 1 / np.maximum(np.bincount(grades, minlength=GRADES), 1)[grades]
    weight = np.sqrt(weight / weight.mean())  # halfway to balanced grades
    weight /= weight.sum()
    for step in range(1, steps + 1):
        line = np.bincount(doc, weights=value * w[at], minlength=len(rows))
        bounds = cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])
        tails = np.hstack([np.ones((len(rows), 1)), _logistic(line[:, None] - bounds), np.zeros((len(rows), 1))])
        slopes = tails * (1 - tails)
        own = np.arange(len(rows))
        p = np.maximum(tails[own, grades] - tails[own, grades + 1], 1e-12)
        by_line = -weight * (slopes[own, grades] - slopes[own, grades + 1]) / p
        by_bound = np.zeros(GRADES - 1)
        for k in range(1, GRADES):
            by_bound[k - 1] = (weight * slopes[:, k] * ((grades == k) * 1.0 - (grades == k - 1)) / p).sum()
        by_cut = np.array([by_bound.sum()] + [by_bound[k:].sum() * np.exp(cut[k]) for k in range(1, GRADES - 1)])
        g = np.concatenate([np.bincount(at, weights=value * by_line[doc], minlength=WIDTH) + ridge * w, by_cut])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, cut = w - move[:WIDTH], cut - move[WIDTH:]
    bounds = cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])
    return {"weights": w.astype(np.float32), "thresholds": bounds.tolist()}


def learn(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> dict | None:
    """Weights and thresholds from about `sample` labelled documents among the usable ids; None without any."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce(F.col("toxic"), F.lit(0)) == 1, 1).otherwise(2)
    known = labels.filter(usable & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", grade.alias("grade"))
    known = known.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    share = min(1.0, sample / max(known.count(), 1))
    place = F.crc32(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")))
    chosen = known.filter(place < int((1 << 32) * share))  # about `sample` rows of two numbers
    texts = one_text_each(docs, chosen)

    def make() -> Callable[[pa.RecordBatch], dict]:
        def step(batch: pa.RecordBatch) -> dict:
            found = [features(t.as_py() or "") for t in batch["text"]]
            return {
                "doc_id": batch["doc_id"].cast(pa.string()),
                "grade": batch["grade"],
                "at": pa.array([f[0].astype(np.int32).tobytes() for f in found], pa.binary()),
                "value": pa.array([f[1].astype(np.float32).tobytes() for f in found], pa.binary()),
            }

        return step

    rows = map_batches(texts, make, "doc_id string, grade int, at binary, value binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["grade"], bytes(r["at"])))  # the fit does not depend on the order of arrival
    if not rows:
        return None
    vectors = [(np.frombuffer(r["at"], dtype=np.int32), np.frombuffer(r["value"], dtype=np.float32)) for r in rows]
    return fit(vectors, np.array([r["grade"] for r in rows]))


def _tails(text: str, model: dict) -> np.ndarray:
    at, value = features(text)
    return _logistic(float(model["weights"][at] @ value) - np.array(model["thresholds"]))


def _scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """All columns of docs, with expected_grade and tail_probability."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def make() -> Callable[[pa.RecordBatch], dict]:
        known = held.value

        def step(batch: pa.RecordBatch) -> dict:
            if known is None:
                tails = np.ones((batch.num_rows, GRADES - 1))
            else:
                tails = np.stack([_tails(t.as_py() or "", known) for t in batch["text"]])
            return {c: batch[c] for c in columns} | {"_grade": pa.array(tails.sum(axis=1)), "_tail": pa.array(tails[:, 0])}

        return step

    kinds = ", ".join(f"`{c}` {type_of(docs, c)}" for c in columns)
    return map_batches(docs, make, f"{kinds}, _grade double, _tail double")


def score(docs: DataFrame, model: dict | None, keep_from: float = KEEP) -> DataFrame:
    """doc_id, expected_grade, tail_probability and kept of every document."""
    scored = _scored(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.col("_grade").alias("expected_grade"), F.col("_tail").alias("tail_probability"), (F.col("_tail") >= keep_from).alias("kept")
    )


def keep(docs: DataFrame, model: dict | None, keep_from: float = KEEP) -> DataFrame:
    """The documents whose tail probability reaches keep_from, unchanged."""
    return _scored(docs, model).filter(F.col("_tail") >= keep_from).select(*docs.columns)
