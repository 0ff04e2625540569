"""Language identification by known words first, then by ever shorter character n-grams.

A word that the word table knows scores its log frequency in each language. An unseen word is read from its start: the
longest known n-gram at a place is taken (GRAM_SIZES from long to short), its log frequencies are added less a penalty
for each order given up, and reading goes on behind it; a letter that no table knows adds the floor. Word scores are
averaged, and the softmax of that average, weighted by the square root of the number of words, gives the score: words of
one text are no independent draws, so certainty grows slower than their number, and at every length by the same law.

Tables are learned from a sample of labelled documents: about DOCS_PER_LANGUAGE of each language, chosen by the hash of
the id. They hold every word and n-gram of the sample, as sorted digests with the languages that have them, so their
size follows the sample and not the number of languages times keys. Languages are taken to be as few as the languages
of the world; the tables are broadcast to the tasks that score.

Defined cases: a missing text, or one without a letter, gets UNKNOWN and score 0, as does every text when nothing was
learned; equal scores go to the first language by name; repeated rows are scored alike; an empty table gives an empty
result; other columns are ignored.
"""

import re
from array import array
from collections.abc import Callable, Iterable, Mapping
from math import log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import id_hash, map_batches, type_of, whole_text

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 3000
GRAM_SIZES = (4, 3, 2, 1)
#: Taken off for each order that is given up.
BACKOFF = 0.9
#: Scores (words times languages) that a task remembers, and words, before it starts anew.
REMEMBERED_SCORES = 16_000_000
REMEMBERED_WORDS = 400_000

_RUNS = re.compile(r"[^\W\d_]+")


def sample_of_languages(docs: DataFrame, usable: Column, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(lang, text) of about per_language usable documents a language; a hash of the id decides."""
    labelled = docs.filter(usable & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    place = F.crc32(F.concat(F.lit("sample:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (place < int((1 << 32) * min(1.0, per_language / n))))
    return labelled.filter(chosen).select("lang", F.lower(whole_text()).alias("text"))


def _sized(size: int) -> Callable[[Column], Column]:
    return lambda gram: F.struct(F.lit(size).alias("size"), gram.alias("gram"))


def learn(docs: DataFrame, usable: Column) -> dict:
    """Tables of log frequencies: words, and n-grams of each size, over the languages in order of name."""
    words = (
        sample_of_languages(docs, usable)
        .select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    # Overlapping n-grams by lookahead: one pass over a word of any length.
    found = [F.transform(F.regexp_extract_all("word", F.lit(f"(?=(.{{{k}}}))"), F.lit(1)), _sized(k)) for k in GRAM_SIZES]
    grams = (
        words.select("lang", "n", F.explode_outer(F.concat(*found)).alias("found"))
        .select("lang", "found.size", "found.gram", "n")
        .filter("gram is not null")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    keys = words.select("lang", F.lit(0).alias("size"), F.col("word").alias("key"), "n").unionByName(
        grams.select("lang", "size", F.col("gram").alias("key"), "n")
    )
    found = keys.toArrow()  # bounded by the sample
    languages = sorted(found["lang"].unique().to_pylist())
    return {"languages": languages, "tables": _tables((r for part in found.to_batches() for r in part.to_pylist()), languages)}


def _packed(keys: array, places: array, counts: array, languages: int) -> dict[str, np.ndarray]:
    """Log frequencies of keys by language: sorted key digests, and for each the languages that have the key.

    A language that lacks a key counts it half a time. Digests have 64 bits: among some million keys two are equal with
    a chance below one in a million. Plain arrays, so that workers need no class of this module to read the broadcast.
    """
    digests, place = np.array(keys, dtype=np.uint64), np.array(places, dtype=np.uint32)
    order = np.lexsort((place, digests))
    digests, place = digests[order], place[order]
    n = np.array(counts, dtype=np.float64)[order] + 0.5
    single, first = np.unique(digests, return_index=True)
    lacking = 0.5 * (len(single) - np.bincount(place, minlength=languages))
    total = np.log(np.maximum(np.bincount(place, weights=n, minlength=languages) + lacking, 0.5))  # 0.5: no key
    return {
        "digests": single,
        "bounds": np.append(first, len(digests)),
        "place": place,
        "logs": (np.log(n) - total[place]).astype(np.float32),
        "lacking": (log(0.5) - total).astype(np.float32),
    }


class Table:
    """Looks keys up in packed log frequencies."""

    def __init__(self, packed: dict[str, np.ndarray]):
        self.digests, self.bounds, self.place = packed["digests"], packed["bounds"], packed["place"]
        self.logs, self.lacking = packed["logs"], packed["lacking"]

    def get(self, key: str) -> np.ndarray | None:
        digest = np.uint64(_digest(key))
        at = self.digests.searchsorted(digest)
        if at == len(self.digests) or self.digests[at] != digest:
            return None
        start, end = self.bounds[at], self.bounds[at + 1]
        scores = self.lacking.copy()
        scores[self.place[start:end]] = self.logs[start:end]
        return scores


def _digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


def _tables(rows: Iterable[Mapping], languages: list[str]) -> dict[int, dict[str, np.ndarray]]:
    """For each size (0: words) the packed table of its keys."""
    place = {lang: k for k, lang in enumerate(languages)}
    columns: dict[int, tuple[array, array, array]] = {}
    for r in rows:
        keys, places, counts = columns.setdefault(r["size"], (array("Q"), array("L"), array("Q")))
        keys.append(_digest(r["key"]))
        places.append(place[r["lang"]])
        counts.append(r["n"])
    return {size: _packed(*lists, len(languages)) for size, lists in columns.items()}


class Scorer:
    """Scores words by the tables; remembers the scores of the words it met."""

    def __init__(self, model: dict):
        n = len(model["languages"])
        none = _packed(array("Q"), array("L"), array("Q"), n)
        self.words = Table(model["tables"].get(0, none))
        self.grams = {size: Table(model["tables"].get(size, none)) for size in GRAM_SIZES}
        self.remembered = min(REMEMBERED_WORDS, REMEMBERED_SCORES // max(n, 1))
        self.floor = np.full(n, log(1e-7), dtype=np.float32)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(self.floor)), dtype=np.float32)

    def unseen(self, word: str) -> np.ndarray:
        total, at, end = self.floor * 0, 0, len(word)
        pieces = 0
        while at < end:
            for given_up, size in enumerate(GRAM_SIZES):
                if at + size <= end and (found := self.grams[size].get(word[at : at + size])) is not None:
                    total = total + found
                    if given_up:
                        total -= BACKOFF * given_up
                    break
            else:
                size, total = 1, total + self.floor
            at, pieces = at + size, pieces + 1
        return total / max(pieces, 1)

    def _place(self, word: str) -> int:
        found = self.words.get(word)
        self.place[word] = k = len(self.place)
        if k == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[k] = self.unseen(word) if found is None else found
        return k

    def mean(self, words: list[str]) -> np.ndarray:
        known = self.place
        at = [known[w] if w in known else self._place(w) for w in words]
        return self.matrix[at].mean(axis=0, dtype=np.float64)


def _predicted(text: str | None, model: dict, scorer: Scorer) -> tuple[str, float]:
    words = _RUNS.findall(text.lower()) if text else []
    if not words or not model["languages"] or not any(c.isalpha() for w in words for c in w):
        return UNKNOWN, 0.0
    mean = scorer.mean(words) * sqrt(len(words))
    odds = np.exp(mean - mean.max())
    best = int(mean.argmax())
    return model["languages"][best], float(odds[best] / odds.sum())


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.RecordBatch], dict]:
        scorer = Scorer(held.value)

        def step(batch: pa.RecordBatch) -> dict:
            langs, scores = [], []
            for text in batch["text"]:
                if len(scorer.place) > scorer.remembered:
                    scorer.forget()
                lang, score = _predicted(text.as_py(), held.value, scorer)
                langs.append(lang)
                scores.append(score)
            return {"doc_id": batch["doc_id"], "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}

        return step

    return map_batches(docs.select("doc_id", "text"), make, f"doc_id {type_of(docs, 'doc_id')}, lang_pred string, score double")


def in_fold(folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text, modulo folds, is fold."""
    return id_hash() % folds == fold
