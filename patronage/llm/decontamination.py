"""Benchmark decontamination by a generalised suffix automaton.

Test items are normalised to words; a window is a run of `window` words of an item, and an item of fewer words is one
window as a whole. The automaton holds every run of words of every item of a block, each once. A document's words stream
through it: at each word it knows the longest run ending there that some item holds. Where that is as long as a window,
the run's words are hit and the state tells the items; shorter items are found along the state's suffix links.

Items are cut into pieces of PIECE words, overlapping by a window less one word, and dealt into blocks of about
BLOCK_WORDS words by hash. So each block's automaton has a bounded size (at most two states a word), whatever the size of
the benchmark. Automata are built in tasks and stored; the driver passes them on one after the other, never all. All
documents meet each block without a shuffle: matches of a block are carried along in the row. With more than one block
the rows are written to the shared folder between blocks.

Defined cases: a missing text has no words; a text without words matches nothing, an item without words has no window;
texts of any length are read whole; rows of one item_id are one item, which has the windows of each; an item without an
id counts as one with an empty id; repeated documents are treated each; empty tables give an empty result or no
matches; clean() keeps all columns.
"""

import pickle
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronage.llm.common import map_batches, normal_words, written

WINDOW = 10
PIECE = 20_000
BLOCK_WORDS = 200_000
#: Share of a document's words above which clean() drops it whole.
MOST = 0.5

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Automaton:
    """All runs of words of some items. A state stands for runs that end at the same places; steps lead on by a word,
    links to the longest shorter run of another state."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.steps: list[dict[int, int]] = [{}]
        self.links, self.lengths = [0], [0]
        self.names: list[str] = []
        held = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items if words]
        for _, tokens in held:
            last = 0
            for token in tokens:
                last = self._extend(last, token)
        self._mark(held)

    def packed(self) -> bytes:
        return pickle.dumps(vars(self), protocol=pickle.HIGHEST_PROTOCOL)

    @classmethod
    def unpacked(cls, data: bytes) -> "Automaton":
        out = cls.__new__(cls)
        vars(out).update(pickle.loads(data))
        return out

    def _clone(self, p: int, token: int, q: int) -> int:
        """A state for the shorter runs of q, those that p leads to."""
        new = len(self.steps)
        self.steps.append(dict(self.steps[q]))
        self.lengths.append(self.lengths[p] + 1)
        self.links.append(self.links[q])
        self.links[q] = new
        while self.steps[p].get(token) == q:
            self.steps[p][token] = new
            if p == 0:
                break
            p = self.links[p]
        return new

    def _extend(self, last: int, token: int) -> int:
        """The state of the run of `last` and one more word."""
        known = self.steps[last].get(token)
        if known is not None:
            return known if self.lengths[known] == self.lengths[last] + 1 else self._clone(last, token, known)
        new = len(self.steps)
        self.steps.append({})
        self.lengths.append(self.lengths[last] + 1)
        self.links.append(0)
        p = last
        while token not in self.steps[p]:
            self.steps[p][token] = new
            if p == 0:
                return new
            p = self.links[p]
        q = self.steps[p][token]
        self.links[new] = q if self.lengths[q] == self.lengths[p] + 1 else self._clone(p, token, q)
        return new

    def _mark(self, held: list[tuple[str, list[int]]]) -> None:
        """Which items have the window that a state's run of `window` words is, and which short items end in a state."""
        links, lengths = self.links, self.lengths
        #: Of a state with runs of window words and more, the state of its last window words.
        self.heads = [-1] * len(links)
        #: The nearest state along the links, the state itself included, in which a short item ends.
        self.short_at = [-1] * len(links)
        by_length = sorted(range(1, len(links)), key=lengths.__getitem__)
        for v in by_length:
            if lengths[v] >= self.window:
                self.heads[v] = v if lengths[links[v]] < self.window else self.heads[links[v]]
        owners: dict[int, set[int]] = {}
        shorts: dict[int, dict[int, set[int]]] = {}
        numbers: dict[str, int] = {}
        for name, tokens in held:
            number = numbers.setdefault(name, len(numbers))
            v = 0
            for k, token in enumerate(tokens):
                v = self.steps[v][token]
                if k + 1 >= self.window:
                    owners.setdefault(self.heads[v], set()).add(number)
            if len(tokens) < self.window:
                shorts.setdefault(v, {}).setdefault(len(tokens), set()).add(number)
        for v in by_length:
            self.short_at[v] = v if v in shorts else self.short_at[links[v]] if links[v] else -1
        self.names = list(numbers)
        self.owners = {v: tuple(sorted(n)) for v, n in owners.items()}
        self.shorts = {v: sorted((k, tuple(sorted(n))) for k, n in by_size.items()) for v, by_size in shorts.items()}
        self.least = min([self.window, *(k for by_size in shorts.values() for k in by_size)])

    def _short_items(self, v: int, length: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Short items that end here: sizes and numbers."""
        u = self.short_at[v]
        while u != -1:
            for k, numbers in self.shorts[u]:
                if u != v or k <= length:
                    yield k, numbers
            u = self.short_at[self.links[u]] if self.links[u] else -1

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words, apart and in order, and the items whose windows occur."""
        tokens = np.array(list(map(self.words.get, words, repeat(-1))), dtype=np.int64)
        known = np.concatenate([[False], tokens >= 0, [False]])
        turns = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)  # runs of words that some item has
        runs = turns[turns[:, 1] - turns[:, 0] >= self.least]
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        found: set[int] = set()
        steps, links, lengths, short_at, window = self.steps, self.links, self.lengths, self.short_at, self.window
        for start, end in runs.tolist():
            v = length = 0
            for place, token in enumerate(tokens[start:end].tolist(), start + 1):
                while (to := steps[v].get(token)) is None and v:
                    v = links[v]
                    length = lengths[v]
                if to is None:
                    length = 0
                    continue
                v, length = to, length + 1
                longest = 0
                if length >= window:
                    states.add(self.heads[v])
                    longest = length
                if short_at[v] != -1:
                    for k, numbers in self._short_items(v, length):
                        found.update(numbers)
                        longest = max(longest, k)
                if longest:
                    spans.append((place - longest, place))
        for v in states:
            found.update(self.owners[v])
        return joined(spans), {self.names[k] for k in found}


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces(benchmark: DataFrame, window: int, piece: int) -> DataFrame:
    """(item_id, words, n): items as normalised words, long ones in pieces that overlap by window - 1 words; each piece
    once."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def step(batch: pa.RecordBatch) -> dict:
            names, texts, sizes = [], [], []
            for name, text in zip(batch["item_id"].to_pylist(), batch["text"].cast(pa.binary()), strict=True):
                words = normal_words(text.as_py() or b"")
                for a in range(0, max(1, len(words) - window + 1) if words else 0, piece):
                    part = words[a : a + piece + window - 1]
                    names.append(name)
                    texts.append(b" ".join(part))
                    sizes.append(len(part))
            return {"item_id": pa.array(names, pa.string()), "words": pa.array(texts, pa.binary()), "n": pa.array(sizes, pa.int64())}

        return step

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return map_batches(items, make, "item_id string, words binary, n long").distinct()


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, piece: int = PIECE) -> DataFrame:
    """(block, automaton): one stored automaton a block of pieces."""
    listed = written(pieces(benchmark, window, piece), "benchmark-pieces")
    total = listed.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    blocks = max(1, -(-total // block_words))

    def build(table: pa.Table) -> pa.Table:
        items = [(name, words.split(b" ")) for name, words in zip(table["item_id"].to_pylist(), table["words"].to_pylist(), strict=True)]
        held = Automaton(items, window).packed()
        return pa.table({"block": table["block"].slice(0, 1), "automaton": pa.array([held], pa.binary())})

    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)).cast("int")
    return written(listed.withColumn("block", block).groupBy("block").applyInArrow(build, "block int, automaton binary"), "automata")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MATCHES = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def _meet(rows: DataFrame, held: Broadcast, with_text: bool) -> DataFrame:
    """Rows of (row, text, spans, items) with the matches of one more automaton, and n_words; without text if not wanted."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        automaton = Automaton.unpacked(held.value)

        def step(batch: pa.RecordBatch) -> dict:
            counts, spans, items = [], [], []
            for text, spans_before, items_before in zip(batch["text"].cast(pa.binary()), batch["spans"], batch["items"], strict=True):
                words = normal_words(text.as_py() or b"")
                found, names = automaton.match(words)
                counts.append(len(words))
                if len(spans_before):
                    found = joined([*((s["start"], s["end"]) for s in spans_before.as_py()), *found])
                    names.update(items_before.as_py())
                spans.append([{"start": a, "end": b} for a, b in found])
                items.append(sorted(names))
            kept = {"row": batch["row"]} | ({"text": batch["text"]} if with_text else {})
            return kept | {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _SPANS), "items": pa.array(items, pa.list_(pa.string()))}

        return step

    schema = StructType([rows.schema["row"], *([rows.schema["text"]] if with_text else []), *StructType.fromDDL(_MATCHES).fields])
    return map_batches(rows.select("row", "text", "spans", "items"), make, schema)


def matches(
    docs: DataFrame, benchmark: DataFrame, columns: tuple[str, ...] = ("doc_id",), with_text: bool = False, window: int = WINDOW, block_words: int = BLOCK_WORDS, piece: int = PIECE
) -> DataFrame:
    """(row, n_words, spans, items) of every document, and text if wanted: row holds the named columns, spans the ranges
    of hit words and items the ids of the items whose windows occur, as text, sorted."""
    stored = automata(benchmark, window, block_words, piece)
    blocks = sorted(r.block for r in stored.select("block").collect())
    spans, items = StructType.fromDDL(_MATCHES).fields[1:]
    rows = docs.select(F.struct(*columns).alias("row"), "text", F.array().cast(spans.dataType).alias("spans"), F.array().cast(items.dataType).alias("items"))
    context = docs.sparkSession.sparkContext
    if not blocks:
        return _meet(rows, context.broadcast(Automaton([], window).packed()), with_text)
    for block in blocks:
        held = context.broadcast(bytes(stored.filter(F.col("block") == block).collect()[0].automaton))
        last = block == blocks[-1]
        rows = _meet(rows, held, with_text or not last)
        if not last:
            rows = written(rows, "decontamination")
    return rows


def _without(text: str, spans: list[dict]) -> str:
    """The text without the characters from each range's first to its last word."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for span in spans:
        out.append(text[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return "".join(out) + text[at:]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: float = MOST, block_words: int = BLOCK_WORDS, piece: int = PIECE) -> DataFrame:
    """Documents, all columns, without the hit ranges of words; a document of which more than `most` of its words are hit
    goes whole."""
    columns = tuple(c for c in docs.columns if c != "text")
    found = matches(docs, benchmark, columns, True, window, block_words, piece)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = found.filter((F.col("n_words") == 0) | (hit <= most * F.col("n_words"))).select("row", "text", "spans")

    def make() -> Callable[[pa.RecordBatch], dict]:
        def step(batch: pa.RecordBatch) -> dict:
            texts = [_without(text.as_py(), spans.as_py()) if len(spans) else text.as_py() for text, spans in zip(batch["text"], batch["spans"], strict=True)]
            return {"row": batch["row"], "text": pa.array(texts, pa.string())}

        return step

    cut = map_batches(kept, make, StructType([kept.schema["row"], kept.schema["text"]]))
    return cut.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
