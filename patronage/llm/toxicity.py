"""Toxicity from a weighted lexicon, found by Aho-Corasick in folded text.

Folding lowers case, drops accents and invisible characters, and maps look-alike letters, digits and signs to one form,
so that "1d10t", "IDIOT" and an "idiot" with foreign look-alikes are the same. The lexicon is learned: words that
labelled toxic documents hold far more often than clean ones, and too often for chance, with the log of that ratio as
weight. Phrases of a lexicon
word and a neighbour that clean documents hold and toxic ones hardly do become exceptions; a hit inside one does not
count. A logistic curve over the summed weight and the summed weight per word gives the score.

Learned from a sample of about SAMPLE labelled documents, chosen by the hash of the id, with one text an id. Lexicon and
exceptions hold all words and phrases of that sample that pass; so the sample bounds them and what is broadcast. A word
needs a log-likelihood ratio that not one of the sample's distinct words would reach by chance, so that few labels can
teach terms too and many teach no accidents.

Defined cases: a missing text counts as empty, an empty text scores as one without hits; without labels of both kinds
the lexicon is empty and every score is 0; words of any length and whole texts are read; repeated rows score alike; an
empty table gives an empty result; other columns are ignored.
"""

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable
from itertools import accumulate
from math import erfc, sqrt

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_batches, one_text_each, type_of, written

SAMPLE = 20_000
#: Toxic sample documents that hold a term, at least, and how many times its share of clean ones.
TERM_DOCS = 3
TERM_RATIO = 20.0
#: Summed weight beyond which a text is no more toxic for it; the weight per word still counts.
MOST_WEIGHT = 40.0
#: Clean documents that hold an exception, at least.
PHRASE_DOCS = 5
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and signs and digits read as letters. Both l and i
# fold to i, as 1, ! and | stand for either.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i", "ь": "b", "г": "r", "п": "n",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "i", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t", "ɑ": "a", "ɡ": "g", "ɩ": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "l": "i"}
SIGNS = {"$": "s", "@": "a", "!": "i", "|": "i", "€": "e", "+": "t", "(": "c"}

_FOLD = str.maketrans(LOOK_ALIKES | DIGITS)
_INVISIBLE = re.compile("[­͏​-‏⁠-⁤︀-️﻿]")
_SIGN_IN_WORD = re.compile(r"(?<=[^\W_])[$@!|€+(](?=[^\W_])|(?<![^\s])[$@](?=[^\W\d_])")
_WORDS = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """One form for all ways to write a word; accents go, look-alikes, digits and signs inside words become letters."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text)).lower()
        text = "".join(c for c in text if not unicodedata.combining(c)) if not text.isascii() else text
    if _SIGN_IN_WORD.search(text):
        text = _SIGN_IN_WORD.sub(lambda m: SIGNS[m[0]], text)
    return text.translate(_FOLD)


def _sampled(labels: DataFrame, usable: Column, sample: int) -> DataFrame:
    """(doc_id, toxic) of about `sample` labelled ids, few enough to broadcast."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(usable & F.col("toxic").isin(0, 1))
    known = known.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    place = F.crc32(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")))
    share = min(1.0, sample / max(known.count(), 1))
    return known.filter(place < int((1 << 32) * share))


def _spread(values: list[list], ids: pa.Array, *columns: list) -> dict:
    """One row a value, with the id and other columns of its document."""
    at = np.repeat(np.arange(len(values)), [len(v) for v in values])
    return {"toxic": ids.take(pa.array(at)), "key": pa.array([k for v in values for k in v], pa.string())}


def evidence_floor(tested: int) -> float:
    """The log-likelihood ratio that one of so many words passes by chance (chi-square of one degree of freedom)."""
    low, high = 0.0, 100.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if erfc(sqrt(middle / 2)) * max(tested, 1) > 1 else (low, middle)
    return high


def _lexicon(texts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    def make() -> Callable[[pa.RecordBatch], dict]:
        return lambda batch: _spread([sorted(set(_WORDS.findall(fold(t.as_py() or "")))) for t in batch["text"]], batch["toxic"])

    words = map_batches(texts.select("toxic", "text"), make, "toxic int, key string")
    toxic, clean = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    held = F.col("toxic") + F.col("clean")
    part = lambda n, of: F.when(n > 0, n * F.log(n * (n_toxic + n_clean) / (held * of))).otherwise(0.0)
    evidence = 2 * (part(F.col("toxic"), n_toxic) + part(F.col("clean"), n_clean))
    counts = written(words.groupBy("key").agg(toxic.alias("toxic"), clean.alias("clean")), "toxicity-words")
    floor = evidence_floor(counts.count())
    rows = counts.withColumn("ratio", ratio).filter((F.col("toxic") >= TERM_DOCS) & (evidence >= floor) & (F.col("ratio") >= TERM_RATIO)).collect()
    return {r["key"]: float(np.log(r["ratio"])) for r in sorted(rows)}


def _exceptions(texts: DataFrame, lexicon: dict[str, float]) -> list[str]:
    """Two-word phrases with a lexicon word that mark clean documents."""
    terms = frozenset(lexicon)

    def phrases(text: str) -> list[str]:
        words = _WORDS.findall(fold(text))
        return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in terms or b in terms})

    def make() -> Callable[[pa.RecordBatch], dict]:
        return lambda batch: _spread([phrases(t.as_py() or "") for t in batch["text"]], batch["toxic"])

    rows = (
        map_batches(texts.select("toxic", "text"), make, "toxic int, key string")
        .groupBy("key")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .filter((F.col("clean") >= PHRASE_DOCS) & (F.col("clean") >= 10 * F.col("toxic")))
        .collect()
    )
    return sorted(r["key"] for r in rows)


def _outside(hits: list[tuple[int, int, float]], excepted: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """Hits that lie in no exception. Exceptions come in order of their ends, as the automaton finds them; of those that
    end at a hit's end or later, the earliest start decides."""
    ends = [b for _, b in excepted]
    starts = list(accumulate((a for a, _ in reversed(excepted)), min))[::-1]
    out = []
    for hit in hits:
        k = bisect_left(ends, hit[1])
        if k == len(ends) or starts[k] > hit[0]:
            out.append(hit)
    return out


class Matcher:
    """Weight of the lexicon's hits in a text, less those inside exception phrases. A term that is itself an exception
    weighs nothing."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str]):
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def weigh(self, text: str) -> tuple[float, int]:
        """Summed weight and number of words."""
        folded = fold(text)
        n_words = len(folded.split())
        if not len(self.automaton):
            return 0.0, n_words
        hits, excepted = [], []
        spaced = " ".join(folded.split())
        for end, (length, weight) in self.automaton.iter(spaced):
            start = end - length + 1
            if (start and spaced[start - 1].isalnum()) or (end + 1 < len(spaced) and spaced[end + 1].isalnum()):
                continue
            if weight is None:
                excepted.append((start, end))
            else:
                hits.append((start, end, weight))
        return sum(w for _, _, w in (_outside(hits, excepted) if excepted else hits)), n_words


def _inputs(weight: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(weight), np.minimum(weight, MOST_WEIGHT) / 10, 100 * weight / np.maximum(n_words, 50) / 10], axis=1)


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 0.02) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge; slopes are kept at 0 or above."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(curvature, gradient), -2, 2)
        w[1:] = np.maximum(w[1:], 0)
    return w


def _weighed(docs: DataFrame, lexicon: dict[str, float], exceptions: list[str], *keep: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast((lexicon, exceptions))

    def make() -> Callable[[pa.RecordBatch], dict]:
        matcher = Matcher(*held.value)

        def step(batch: pa.RecordBatch) -> dict:
            found = [matcher.weigh(t.as_py() or "") for t in batch["text"]]
            weights, counts = zip(*found, strict=True)
            return {c: batch[c] for c in keep} | {"weight": pa.array(weights, pa.float64()), "n_words": pa.array(counts, pa.int64())}

        return step

    kinds = ", ".join(f"{c} {type_of(docs, c)}" for c in keep)
    return map_batches(docs.select(*keep, "text"), make, f"{kinds}, weight double, n_words long")


def learn(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE, exceptions: tuple[str, ...] = ()) -> dict:
    """Lexicon, exception phrases and curve. usable says which ids may be learned from; exceptions adds known phrases."""
    chosen = _sampled(labels, usable, sample)
    texts = written(one_text_each(docs, chosen).select("toxic", "text"), "toxicity-sample")
    counts = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return {"lexicon": {}, "exceptions": [], "curve": None}
    lexicon = _lexicon(texts, counts[1], counts[0])
    phrases = sorted({fold(p) for p in exceptions} | set(_exceptions(texts, lexicon)))
    rows = _weighed(texts, lexicon, phrases, "toxic").collect()  # about `sample` rows of three numbers
    x = _inputs(np.array([r["weight"] for r in rows]), np.array([r["n_words"] for r in rows]))
    return {"lexicon": lexicon, "exceptions": phrases, "curve": _fit(x, np.array([r["toxic"] for r in rows], dtype=float)).tolist()}


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every document."""
    weighed = _weighed(docs, model["lexicon"], model["exceptions"], "doc_id")
    if model["curve"] is None:
        value = F.lit(0.0)
    else:
        bias, by_sum, by_share = model["curve"]
        share = 10 * F.col("weight") / F.greatest("n_words", F.lit(50))
        value = 1 / (1 + F.exp(-(bias + by_sum * F.least("weight", F.lit(MOST_WEIGHT)) / 10 + by_share * share)))
    return weighed.select("doc_id", value.alias("score"), (value >= threshold).cast("int").alias("predicted"))
