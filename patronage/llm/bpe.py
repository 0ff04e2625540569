"""Byte-level BPE over a table of distinct words.

1. Tasks split their documents into words as the tokenizer does and close a block every BLOCK_CHARS characters, or where
   its words and their sequence reach BLOCK_BYTES of memory. A block
   keeps each of its distinct words once, dealt into buckets by hash, and its documents as sequences of places in that
   word list, ranked by frequency. Blocks are written to the shared folder.
2. Word lists are shuffled by bucket; a task meets all words of its bucket and encodes each distinct one once.
3. The ids return to their block, where the sequences turn into ids by position, and ids into text through the table
   from id to piece.

Only word lists move twice; a frequent word moves once a block, so it can't fill a task. The tokenizer and its table of
pieces have a fixed size and go to every task; the tokenizer's file is a parameter and is read on the driver.

Defined cases: a missing text counts as empty, an empty text has no ids; a word or text of any length stays whole;
special tokens that stand in a text get their own id, as in the tokenizer's own encoding; repeated rows are encoded
each; an empty table gives an empty result; other columns are ignored.
"""

import hashlib
import json
import re
from array import array
from collections.abc import Callable
from itertools import accumulate, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm.common import give_back, type_of, written

BLOCK_CHARS = 32_000_000
#: Estimated memory of a block's words and sequence at which it is closed, whatever its characters.
BLOCK_BYTES = 224_000_000
#: Ranks packed or unpacked at a time.
_SLICE = 1 << 20
#: Distinct words of a bucket that a task remembers before it starts anew.
REMEMBERED = 1_000_000

#: The tokenizer's split for the scripts where this module's characters classes surely agree with the tokenizer's.
_SPLIT = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_ONE, _TWO = 160, 160 + (64 << 8)
_THREE = _TWO + (31 << 16)
_UNSURE = re.compile("[\x1c-\x1f²³¹¼-¾ɐ-\U0010ffff]")


def read_tokenizer(path: str) -> str:
    """The tokenizer's definition, with truncation and padding off."""
    with open(path, encoding="utf-8") as file:
        definition = json.load(file)
    return json.dumps(definition | {"truncation": None, "padding": None})


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of byte-level pieces: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def pieces_of(definition: str) -> list[bytes]:
    """Bytes of each id."""
    letters = _byte_letters()
    whole = Tokenizer.from_str(definition).get_vocab(with_added_tokens=True)
    out = [b""] * (max(whole.values()) + 1)
    for piece, k in whole.items():
        out[k] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
    return out


class Splitter:
    """Splits text into the strings that the tokenizer encodes one by one."""

    def __init__(self, definition: str):
        self.own = Tokenizer.from_str(definition).pre_tokenizer
        special = [t["content"] for t in json.loads(definition).get("added_tokens", [])]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def _plain(self, text: str) -> list[str]:
        if _UNSURE.search(text):
            return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def split(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)  # odd places hold the special tokens
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self._plain(part))]


def _packed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _packed_ranks(ranks: np.ndarray) -> bytes:
    """Ranks by frequency in one to five bytes: one below 160, two or three with the page in the first byte, else the
    whole number behind 255. First, second and further bytes are compressed apart."""
    planes: list[list[bytes]] = [[], [], [], [], []]
    for at in range(0, len(ranks), _SLICE):
        r = ranks[at : at + _SLICE].astype(np.int64)
        two, three, whole = (r >= _ONE) & (r < _TWO), (r >= _TWO) & (r < _THREE), r >= _THREE
        head = np.where(two, _ONE + ((r - _ONE) >> 8), np.where(three, 224 + ((r - _TWO) >> 16), np.where(whole, 255, r)))
        low, far = (r[two] - _ONE) & 255, (r[three] - _TWO) & 65535
        for plane, numbers in zip(planes, (head, low, far & 255, far >> 8), strict=False):
            plane.append(numbers.astype(np.uint8).tobytes())
        planes[4].append(r[whole].astype("<u4").tobytes())
    packed = [zstandard.ZstdCompressor(level=3).compress(b"".join(p)) for p in planes]
    sizes = np.array([len(p) for p in packed], dtype="<u4")
    return sizes.tobytes() + b"".join(packed)


def _unpacked_ranks(data: bytes) -> np.ndarray:
    cuts = np.cumsum([20, *np.frombuffer(data, dtype="<u4", count=5)])
    parts = [zstandard.ZstdDecompressor().decompress(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    head, low, far, page = (np.frombuffer(p, dtype=np.uint8) for p in parts[:4])
    r = head.astype(np.uint32)
    two, three = (head >= _ONE) & (head < 224), (head >= 224) & (head < 255)
    r[two] = _ONE + ((r[two] - _ONE) << 8) + low
    r[three] = _TWO + ((r[three] - 224) << 16) + (page.astype(np.uint32) << 8) + far
    r[head == 255] = np.frombuffer(parts[4], dtype="<u4")
    return r


def _pack_words(words: list[str]) -> bytes:
    lengths = np.array([len(words), *map(len, words)], dtype="<u4")
    return zstandard.ZstdCompressor(level=3).compress(lengths.tobytes() + "".join(words).encode())


def _unpack_words(data: bytes) -> list[str]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:4], "little")
    cuts = [0, *accumulate(np.frombuffer(raw, dtype="<u4", count=n, offset=4).tolist())]
    text = raw[4 + 4 * n :].decode()
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class _Block:
    """Documents of one block: ids, word counts and words as places in the list of distinct words."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.ids: list = []
        self.counts: list[int] = []
        self.places = array("I")
        self.known: dict[str, int] = {}
        self.letters = 0

    def add(self, doc_id: object, words: list[str], chars: int) -> None:
        known = self.known
        self.ids.append(doc_id)
        self.counts.append(len(words))
        before = len(known)
        self.places.extend([known.setdefault(w, len(known)) for w in words])
        if len(known) > before:
            self.letters += sum(map(len, islice(reversed(known), len(known) - before)))
        self.chars += chars

    def is_full(self, block_chars: int) -> bool:
        """A word costs its letters and some 200 bytes in the dictionary and the lists that row() makes of it."""
        return self.chars >= block_chars or 12 * len(self.places) + 200 * len(self.known) + 2 * self.letters >= BLOCK_BYTES

    def row(self, buckets: int) -> dict:
        """Words are ranked by frequency, which packs their sequence best; the list goes bucket by bucket, by rank."""
        places = np.frombuffer(self.places, dtype=np.uint32)
        ranked = np.argsort(-np.bincount(places, minlength=len(self.known)), kind="stable")
        rank = np.empty(len(ranked), dtype=np.uint32)
        rank[ranked] = np.arange(len(ranked))
        words = list(self.known)
        words = [words[k] for k in ranked]
        bucket = np.fromiter((crc32(w.encode()) % buckets for w in words), dtype=np.int64, count=len(words))
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        parts = [_pack_words([words[k] for k in order[a:b]]) for a, b in zip(ends, ends[1:], strict=False)]
        sequence = _packed_ranks(rank[places])
        digest = xxhash.xxh64(sequence)
        for part in parts:
            digest.update(part)
        digest.update(repr((TaskContext.get().partitionId(), self.number, self.ids)).encode())
        return {
            "block": digest.intdigest() - (1 << 63),
            "ids": self.ids,
            "counts": _packed(np.array(self.counts, dtype=np.uint32)),
            "sequence": sequence,
            "buckets": _packed(bucket),
            "parts": parts,
        }


def blocks_of(docs: DataFrame, definition: str, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents as blocks: ids, word counts, the sequence of places, and the distinct words by bucket."""
    kind = type_of(docs, "doc_id")
    schema = f"block long, ids array<{kind}>, counts binary, sequence binary, buckets binary, parts array<binary>"
    arrow_kind = pa.schema([("block", pa.int64()), ("ids", pa.list_(_arrow_type(docs))), ("counts", pa.binary()), ("sequence", pa.binary()), ("buckets", pa.binary()), ("parts", pa.list_(pa.binary()))])

    def run(batches):
        splitter, block = Splitter(definition), _Block(0)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = text.as_py() or ""
                block.add(doc_id, splitter.split(text), len(text))
                if block.is_full(block_chars):
                    yield pa.RecordBatch.from_pylist([block.row(buckets)], arrow_kind)
                    block = _Block(block.number + 1)
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.row(buckets)], arrow_kind)
        del block
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _arrow_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


def encode_words(parts: DataFrame, definition: str) -> DataFrame:
    """(block, bucket, lengths, ids) for rows of (block, bucket, words) that follow each other by bucket. No word stands
    in two buckets, so a task forgets a bucket's words behind it."""
    schema = "block long, bucket int, lengths binary, ids binary"

    def run(batches):
        tokenizer = Tokenizer.from_str(definition)
        known: dict[str, list[int]] = {}
        at = None
        for batch in batches:
            lengths, ids = [], []
            for bucket, packed in zip(batch["bucket"].to_pylist(), batch["words"], strict=True):
                words = _unpack_words(packed.as_py())
                if bucket != at or len(known) > REMEMBERED:
                    known.clear()
                at = bucket
                fresh = [w for w in words if w not in known]
                for word, found in zip(fresh, tokenizer.encode_batch(fresh, add_special_tokens=False), strict=True):
                    known[word] = found.ids
                found = [known[w] for w in words]
                lengths.append(_packed(np.fromiter(map(len, found), dtype=np.uint32, count=len(found))))
                ids.append(_packed(np.array([k for f in found for k in f], dtype=np.uint32)))
            yield pa.RecordBatch.from_pydict({"block": batch["block"], "bucket": batch["bucket"], "lengths": pa.array(lengths, pa.binary()), "ids": pa.array(ids, pa.binary())})
        known.clear()
        give_back()

    return parts.mapInArrow(run, schema)


def _sequences(block: pa.Table, parts: pa.Table) -> tuple[list, list[np.ndarray]]:
    """Ids of the block's documents and their token ids, by joining places with the encoded words."""
    if block.num_rows != 1:
        raise ValueError("a block's words came back without its documents: its input changed between two reads")
    parts = parts.sort_by("bucket")
    lengths = np.concatenate([np.zeros(0, "<u4"), *(_unpacked(p.as_py()) for p in parts["lengths"])])
    flat = np.concatenate([np.zeros(0, "<u4"), *(_unpacked(p.as_py()) for p in parts["ids"])])
    order = np.argsort(_unpacked(block["buckets"][0].as_py()), kind="stable")  # ranks in the order of the list
    if len(lengths) != len(order):
        raise ValueError("a block's documents came without all of its words")
    listed = lengths.astype(np.int64)
    starts, lengths = np.empty_like(listed), np.empty_like(listed)
    starts[order], lengths[order] = np.cumsum(listed) - listed, listed
    sequence = _unpacked_ranks(block["sequence"][0].as_py())
    cuts = np.concatenate([[0], np.cumsum(_unpacked(block["counts"][0].as_py()), dtype=np.int64)])
    tokens = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        places = sequence[a:b]
        n = lengths[places]
        upto = np.cumsum(n)
        total = int(upto[-1]) if len(n) else 0
        tokens.append(flat[np.arange(total) + np.repeat(starts[places] - (upto - n), n)])
    return block["ids"][0].as_py(), tokens


def _joined(docs: DataFrame, definition: str, columns: str, make: Callable[[], Callable[[list[np.ndarray]], dict]], block_chars: int) -> DataFrame:
    """doc_id and the columns that make() derives from each document's token ids."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = written(blocks_of(docs, definition, buckets, block_chars), "bpe-blocks")
    parts = blocks.select("block", F.posexplode("parts").alias("bucket", "words")).repartition("bucket").sortWithinPartitions("bucket")
    encoded = encode_words(parts, definition)
    id_type = _arrow_type(docs)

    def join(block: pa.Table, found: pa.Table) -> pa.Table:
        ids, tokens = _sequences(block, found)
        out = pa.table({"doc_id": pa.array(ids, id_type)} | make()(tokens))
        del tokens
        give_back()
        return out

    left = blocks.select("block", "ids", "counts", "sequence", "buckets").groupBy("block")
    return left.cogroup(encoded.groupBy("block")).applyInArrow(join, f"doc_id {type_of(docs, 'doc_id')}, {columns}")


def encode(docs: DataFrame, definition: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and the token ids of every document."""

    def make() -> Callable[[list[np.ndarray]], dict]:
        return lambda tokens: {"ids": pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32()))}

    return _joined(docs, definition, "ids array<int>", make, block_chars)


def decode(ids: np.ndarray, pieces: list[bytes]) -> str:
    """Text of token ids, by their pieces."""
    return b"".join(map(pieces.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


def round_trip(docs: DataFrame, definition: str, with_ids: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens, the digest of the ids as little-endian unsigned 32-bit numbers, that of the text decoded from
    them, and the ids if wanted."""
    held = docs.sparkSession.sparkContext.broadcast(pieces_of(definition))

    def digests(tokens: list[np.ndarray]) -> dict:
        found = {
            "n_tokens": pa.array(map(len, tokens), pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(t.astype("<u4").tobytes()).hexdigest() for t in tokens], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(decode(t, held.value).encode()).hexdigest() for t in tokens], pa.string()),
        }
        return found | ({"ids": pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32()))} if with_ids else {})

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _joined(docs, definition, columns, lambda: digests, block_chars)
