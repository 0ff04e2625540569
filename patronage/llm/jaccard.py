"""Join of word-shingle sets by Jaccard similarity, by a partition of the universe and the pigeonhole principle.

Two sets with similarity t differ in a bounded number H of members. Shingles are hashed into H + 1 segments, so similar
sets agree in at least one segment's subset. H depends on size, so segments belong to a size band, and a set takes part
in its own band, with sets of its size, and in the band below, with smaller sets.

A subset is indexed by its hash. An empty subset would meet every other empty one, so a cost rule spends nothing on it
and pays with a one-deletion neighbourhood elsewhere: in a segment that allows one difference, the subset also meets
itself less any one member. A set with e empty segments needs e such segments; they are taken from the band's first
segments (`_paid`), and sets without empty segments need none. Where too few segments can pay, the empty ones are
indexed after all. For any two similar sets:

* one has no empty segment: both index the segment where they agree, as it is not empty;
* both have some: among the segments of one, the allowed differences add up to H + 1, so some segment differs by less
  than it allows; if it allows one, the two subsets agree or one of them is the other less a member, and both sets
  index the deletions of the paying segments.

Sets that are equal are one node from the start. Nodes that meet at a key are candidates: up to FEW of them all with
each other; more of them through the key's hub, the node with the most larger keys: a row a node, and a hub that most
others resemble joins them at once. Candidates are verified exactly. Larger keys whose nodes
are then still in different components are compared in blocks of BLOCK nodes: a task meets the parity sketches of two
blocks and gives the pairs of different components whose sketches differ in no more bits than the similarity allows
members. A differing member turns one bit, so no similar pair is lost, and pairs that are not similar hardly come
through. So a group of thousands of near copies is neither paired out nor held whole, and no link that joins two
components is lost.

Defined cases: a missing text or one without words has an empty set and no links; a text shorter than a shingle has its
whole sequence as its one shingle; a missing id is grouped like any other and ignored as a component's smallest id
unless there is no other; rows that repeat an id or a text are kept; an empty table gives an empty result; other columns
are ignored.
"""

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import give_back, map_batches, type_of, written
from patronage.llm.components import components

#: A text's set, and a task's maker of the function from a set to its index keys.
Items = Callable[[str | None], np.ndarray]
MakeKeys = Callable[[], Callable[[np.ndarray], np.ndarray]]

#: Nodes of a key that are all compared with each other.
FEW = 8
BLOCK = 1000
#: Index keys that a task packs together.
BLOCK_KEYS = 1_000_000
#: Members of sets for each bucket of index keys.
BUCKET_MEMBERS = 2_000_000
#: Sketch bits for each member in which similar sets may differ.
BITS_EACH = 8

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of `width` words; A-Z are lower-cased."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        width = min(width, len(words))
        joined = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            joined = (joined ^ hashed[k : len(words) - width + 1 + k]) * _C
            joined ^= joined >> np.uint64(30)
        return np.unique(_mixed(joined))


def node_of(items: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(items.tobytes()) - (1 << 63)


class Bands:
    """Size bands for a similarity of percent / 100: band k holds sizes from low[k] to high[k]."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.high = [1], [100 // percent]

    def of(self, size: int) -> int:
        while self.high[-1] < size:
            self.low.append(self.high[-1] + 1)
            self.high.append(self.low[-1] * 100 // self.percent)
        return int(np.searchsorted(self.high, size))

    def segments(self, band: int) -> int:
        """One more than the most members in which two similar sets differ, the smaller of them in this band."""
        return self.high[band] * (100 - self.percent) // self.percent + 1


def _paid(segments: int) -> int:
    """How many of a band's first segments may pay for empty ones."""
    return min(segments, 6 + segments // 12)


def _keys_in(items: np.ndarray, band: int, segments: int) -> np.ndarray:
    """Index keys of a set for one band."""
    with np.errstate(over="ignore"):
        own = _mixed(items + np.uint64(band))
        segment = (own % np.uint64(segments)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        own, segment = own[order] * _C, segment[order]
        counts = np.bincount(segment, minlength=segments)
        ends = np.cumsum(counts)
        upto = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(own, dtype=np.uint64)])
        sums = upto[ends] - upto[ends - counts]
        place = np.arange(segments, dtype=np.uint64) * _A + np.uint64(band) * _B

        def keyed(total: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
            return _mixed(_mixed(total + count.astype(np.uint64) * _B) ^ place[at])

        full = np.flatnonzero(counts)
        empty = segments - len(full)
        if not empty:
            return keyed(sums, counts, np.arange(segments))
        paying = _paid(segments)
        payers = np.flatnonzero(counts[:paying] >= 2)
        indexed = full if len(payers) >= empty else np.arange(segments)
        keys = [keyed(sums[indexed], counts[indexed], indexed)]
        less = (segment < paying) & (counts[segment] >= 2)
        keys.append(keyed(sums[segment[less]] - own[less], counts[segment[less]] - 1, segment[less]))
        return np.concatenate(keys)


def keys_of(items: np.ndarray, bands: Bands) -> np.ndarray:
    """Index keys of a set: in its own band, and in the band below. Bands that allow no difference need none."""
    if not len(items):
        return np.zeros(0, dtype=np.uint64)
    band = bands.of(len(items))
    found = [_keys_in(items, k, bands.segments(k)) for k in (band, band - 1) if k >= 0 and bands.segments(k) > 1]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def _as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def sets_of(docs: DataFrame, items_of: Items, also: tuple[str, ...] = (), percent: int | None = None) -> DataFrame:
    """(doc_id, node, n_items) of every row, the columns of docs named in also and, where a percent is given, the sketch."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def step(batch: pa.RecordBatch) -> dict:
            nodes, sizes, sketches = [], [], []
            for text in batch["text"]:  # one set at a time: a batch's sets are larger than its texts
                items = items_of(text.as_py())
                nodes.append(node_of(items))
                sizes.append(len(items))
                if percent is not None:
                    sketches.append(_sketch(items, percent))
            sketched = {} if percent is None else {"sketch": pa.array(sketches, pa.binary())}
            return {"doc_id": batch["doc_id"], "node": nodes, "n_items": sizes} | {c: batch[c] for c in also} | sketched

        return step

    kinds = "".join(f", {c} {type_of(docs, c)}" for c in also) + (", sketch binary" if percent is not None else "")
    return map_batches(docs.select("doc_id", "text", *also), make, f"doc_id {type_of(docs, 'doc_id')}, node long, n_items long{kinds}")


def _packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _indexed(docs: DataFrame, items_of: Items, make_keys: MakeKeys, buckets: int) -> DataFrame:
    """(bucket, nodes, keys, at): a block's index keys of one bucket, sorted and as differences, with the place of each
    key's node in nodes. A task indexes a set it has met before only once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of_set, met = make_keys(), set()
        nodes: list[int] = []
        keys: list[np.ndarray] = []
        n_keys = 0

        def closed() -> pa.RecordBatch:
            every = np.concatenate(keys)
            at = np.repeat(np.arange(len(keys), dtype=np.uint32), [len(k) for k in keys])
            keys.clear()
            bucket = (every % np.uint64(buckets)).astype(np.uint32)
            order = np.lexsort((every, bucket))
            every, at, bucket = every[order], at[order], bucket[order]
            del order
            held, out = np.array(nodes, dtype=np.int64).view(np.uint64), []
            for a, b in zip(*(lambda c: (c[:-1], c[1:]))(np.searchsorted(bucket, np.arange(buckets + 1))), strict=True):
                if a < b:
                    own, place = np.unique(at[a:b], return_inverse=True)
                    steps = np.diff(every[a:b], prepend=np.uint64(0))
                    out.append((int(bucket[a]), held[own.astype(np.int64)].tobytes(), _packed(steps), _packed(place)))
            nodes.clear()
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_pydict({c: pa.array([o[k] for o in out], kinds[k]) for k, c in enumerate(("bucket", "nodes", "keys", "at"))})

        for batch in batches:
            for text in batch["text"]:
                items = items_of(text.as_py())
                if (node := node_of(items)) not in met:
                    met.add(node)
                    if len(found := keys_of_set(items)):
                        nodes.append(node)
                        keys.append(found)
                        n_keys += len(found)
                if n_keys >= BLOCK_KEYS:
                    yield closed()
                    n_keys = 0
        if keys:
            yield closed()
        met.clear()
        give_back()

    return docs.select("text").mapInArrow(run, "bucket int, nodes binary, keys binary, at binary")


def _met_at(keys: np.ndarray, nodes: np.ndarray) -> tuple[list[int | None], list[int], list[int]]:
    """Candidates (large, a, b) among (key, node): the pairs of small keys, and the nodes of larger ones as (key, node,
    node)."""
    order = np.argsort(keys)
    keys, met = keys[order], np.zeros(len(keys) + 1, dtype=bool)
    met[1:-1] = keys[1:] == keys[:-1]
    met = met[1:] | met[:-1]  # most keys have one node only and go before anything else is copied
    keys, nodes = keys[met], nodes[order[met]]
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    large, a, b = [], [], []
    for n in range(2, FEW + 1):
        for k in range(n):
            for j in range(k + 1, n):
                first = starts[sizes == n]
                a.append(nodes[first + k])
                b.append(nodes[first + j])
    n_pairs = sum(map(len, a))
    wide = np.repeat(sizes > FEW, sizes)
    large = [None] * n_pairs + _as_long(keys[wide]).tolist()
    a.append(nodes[wide])
    b.append(nodes[wide])
    return large, np.concatenate(a).tolist(), np.concatenate(b).tolist()


def candidates(docs: DataFrame, items_of: Items, make_keys: MakeKeys, members: int) -> DataFrame:
    """(large, a, b): node pairs that meet at a key, and the nodes of keys with more than FEW of them.

    A bucket holds its keys of all blocks at once, sixteen bytes each. Their number goes with the `members` of all sets,
    about a key each, so buckets keep their size as the documents grow.
    """
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-members // BUCKET_MEMBERS))
    rows = _indexed(docs, items_of, make_keys, buckets).repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, nodes = None, [], []

        def closed() -> pa.RecordBatch:
            every, of = np.concatenate(keys), np.concatenate(nodes)
            keys.clear()
            nodes.clear()
            found = _met_at(every, of)
            return pa.RecordBatch.from_pydict({c: pa.array(f, pa.int64()) for c, f in zip(("large", "a", "b"), found, strict=True)})

        for batch in batches:
            for bucket, held, packed, places in zip(*(batch[c].to_pylist() for c in ("bucket", "nodes", "keys", "at")), strict=True):
                if bucket != at and keys:
                    yield closed()
                at = bucket
                keys.append(np.cumsum(_unpacked(packed), dtype=np.uint64))
                nodes.append(np.frombuffer(held, dtype=np.int64)[_unpacked(places).astype(np.int64)])
        if keys:
            yield closed()
        give_back()

    return rows.mapInArrow(run, "large long, a long, b long")


def _sketch(items: np.ndarray, percent: int) -> bytes:
    """Parity sketch: each member turns one bit. Its length, a power of two, grows with the set; a longer one folds to a
    shorter one."""
    allowed = len(items) * (100 - percent) // percent + 1
    bits = max(64, 1 << (BITS_EACH * allowed - 1).bit_length())
    turned = np.bincount((_mixed(items) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(turned.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: bytes, length: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, dtype=np.uint8).reshape(-1, length), axis=0)


def _differing(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ: no more than the sets have differing members."""
    length = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, length) ^ _folded(b, length)).sum())


def _items_of(docs: DataFrame, members: DataFrame, needed: DataFrame, items_of: Items, percent: int) -> DataFrame:
    """(node, n, sketch, items) of the needed nodes, from the text of one document of each, told apart by id and text
    digest: rows of one id, or without one, meet their own node alone."""
    one = F.min(F.struct("doc_id", "_digest")).alias("one")
    wanted = members.join(needed, "node", "left_semi").groupBy("node").agg(one).select("node", "one.*")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_digest"))
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["_digest"] == wanted["_digest"])
    texts = rows.join(wanted, same).select("node", "text")

    def make() -> Callable[[pa.RecordBatch], dict]:
        def step(batch: pa.RecordBatch) -> dict:
            nodes, items = [], []
            for node, text in zip(batch["node"].to_pylist(), batch["text"], strict=True):
                own = items_of(text.as_py())
                if node_of(own) == node:  # an id may stand on several texts
                    nodes.append(node)
                    items.append(own)
            return {
                "node": pa.array(nodes, pa.int64()),
                "n": pa.array(map(len, items), pa.int64()),
                "sketch": pa.array([_sketch(i, percent) for i in items], pa.binary()),
                "items": pa.array(map(_as_long, items), pa.list_(pa.int64())),
            }

        return step

    return map_batches(texts, make, "node long, n long, sketch binary, items array<long>").dropDuplicates(["node"])


def _sketches(members: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, n, sketch) of the needed nodes."""
    return members.join(needed, "node", "left_semi").select("node", F.col("n_items").alias("n"), "sketch").dropDuplicates(["node"])


def _may_be_near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches allow the similarity; sketches are far smaller than sets."""
    of_a = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("of_a"))
    of_b = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("of_b"))
    sketched = pairs.join(of_b, "b").join(of_a, "a").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("of_a", "of_b", "na", "nb")]
            near = [_differing(x, y) * (100 + percent) <= (100 - percent) * (n + m) for x, y, n, m in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return sketched.select("a", "b", "na", "nb", "of_a", "of_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity reaches percent / 100, by exact counts."""
    of_a = items.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("items").alias("of_a"))
    of_b = items.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("items").alias("of_b"))
    both = pairs.join(of_b, "b").join(of_a, "a").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    return both.select("a", "b", "na", "nb", common.alias("c")).filter(100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def _open(large: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root) of the larger keys whose nodes lie in different components."""
    placed = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("key")
    return placed.join(open_keys, "key")


def _hub_pairs(large: DataFrame) -> DataFrame:
    """(a, b): the nodes of each larger key with the key's hub, the node with the most larger keys."""
    degrees = large.join(large.groupBy("node").agg(F.count("*").alias("degree")), "node")
    hubs = degrees.groupBy("key").agg(F.max(F.struct("degree", F.col("node").alias("hub"))).alias("best")).select("key", "best.hub")
    met = large.join(hubs, "key").filter(F.col("node") != F.col("hub"))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def _second_hub_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): the nodes of each open key with its second hub, the node with the most open keys outside the component of
    the first such node. Pairs within a component are left out."""
    degrees = rows.join(rows.groupBy("node").agg(F.count("*").alias("degree")), "node")
    best = F.max(F.struct("degree", "node", "root")).alias("best")
    first = degrees.groupBy("key").agg(best).select("key", F.col("best.root").alias("first_root"))
    outside = degrees.join(first, "key").filter(F.col("root") != F.col("first_root"))
    hubs = outside.groupBy("key").agg(best).select("key", F.col("best.node").alias("hub"), F.col("best.root").alias("hub_root"))
    met = rows.join(hubs, "key").filter(F.col("root") != F.col("hub_root"))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def _near_in_block(group: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Pairs of different components, one of side 0 and one of side 1 (or both of one block), whose sizes and sketches
    allow the similarity. Rows are (side, node, root, n, sketch)."""
    length = min(len(r[4]) for r in group)
    folded = np.zeros((len(group), length), dtype=np.uint8)
    for k, row in enumerate(group):
        folded[k] = _folded(row[4], length)
    words = folded.view(np.uint64)
    side, node, root, size = (np.array([r[k] for r in group], dtype=np.int64) for k in range(4))
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1) if side.any() else first
    out = []
    for k in first:
        fit = second[(root[second] != root[k]) & (100 * np.minimum(size[second], size[k]) >= percent * np.maximum(size[second], size[k]))]
        differing = np.bitwise_count(words[fit] ^ words[k]).sum(axis=1, dtype=np.int64)
        near = fit[differing * (100 + percent) <= (100 - percent) * (size[fit] + size[k])]
        out.extend((min(int(node[k]), n), max(int(node[k]), n)) for n in node[near].tolist())
    return out


def _rest(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet at a larger key and whose sketches allow the similarity."""
    counts = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # A block meets itself and each other block once: the row goes to all pairs of blocks that hold its own.
    pair = F.explode(F.expr("transform(sequence(0, blocks - 1), k -> struct(least(k, own) AS i, greatest(k, own) AS j))"))
    dealt = (
        rows.join(counts, "key")
        .withColumn("own", own)
        .withColumn("pair", pair)
        .select("key", "pair.i", "pair.j", ((F.col("own") != F.col("pair.i"))).cast("int").alias("side"), "node", "root")
        .join(sketches, "node")
    )
    columns = ["key", "i", "j", "side", "node", "root", "n", "sketch"]
    sorted_rows = dealt.select(*columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def near() -> pa.RecordBatch:
            found = sorted(set(_near_in_block(group, percent))) if len(group) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in columns), strict=True):
                if row[:3] != at:
                    if group:
                        yield near()
                    at, group = row[:3], []
                group.append(row[3:])
        if group:
            yield near()

    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, items_of: Items, make_keys: MakeKeys, percent: int, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, node, n_items, root and the columns named in also of every row: rows of one root are linked by sets whose
    similarity reaches percent / 100. Any two such sets have to share an index key.

    Candidates meet as sketches, which are stored with the members. Only sets of pairs that these allow are made again from
    their texts and moved."""
    keyed = docs.withColumn("_digest", F.xxhash64("text"))
    members = written(sets_of(keyed, items_of, (*also, "_digest"), percent), "jaccard-sets")
    total = members.agg(F.coalesce(F.sum("n_items"), F.lit(0))).collect()[0][0]
    met = written(candidates(docs, items_of, make_keys, total), "jaccard-met")
    needed = met.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sketches = written(_sketches(members, needed), "jaccard-sketches")

    def exact(pairs: DataFrame, name: str) -> DataFrame:
        near = written(_may_be_near(pairs.distinct(), sketches, percent), "jaccard-near")
        if near.isEmpty():
            return near
        of_near = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        items = written(_items_of(docs, members, of_near, items_of, percent).select("node", "n", "items"), "jaccard-items")
        return written(verified(near, items, percent), name)

    few = met.filter("large is null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    large = written(met.filter("large is not null").select(F.col("large").alias("key"), F.col("a").alias("node")).distinct(), "jaccard-large")
    links = exact(few.union(_hub_pairs(large)), "jaccard-links")
    roots = components(links)
    rows = written(_open(large, roots), "jaccard-open")
    # A second hub joins most of what the first left apart, before blocks compare the rest pair by pair.
    for pairs, name in ((_second_hub_pairs, "jaccard-second"), (partial(_rest, sketches=sketches, percent=percent), "jaccard-rest")):
        if rows.isEmpty():
            break
        more = exact(pairs(rows), name)
        if not more.isEmpty():
            links = links.union(more)
            roots = components(links)
            rows = written(_open(rows.select("key", "node"), roots), "jaccard-open") if name == "jaccard-second" else rows
    return members.drop("sketch").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _banded(percent: int) -> Callable[[np.ndarray], np.ndarray]:
    return partial(keys_of, bands=Bands(percent))


def linked(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, node, n_shingles and component_id of every row: the smallest id that links reach from it."""
    ids = classes(docs, partial(shingles, width=width), partial(_banded, percent), percent).withColumnRenamed("n_items", "n_shingles")
    least = ids.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return ids.join(least, "root", "left").select(
        "doc_id", "node", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, unchanged: the one with the smallest id, a missing id behind all others; of rows that
    repeat it the one with the least text digest, and one of those whose text is equal too. Documents with an empty set
    all stay.

    Rows are told apart by id and text digest. Of a kept key on several rows, each task keeps one row before the shuffle,
    so that a text on a third of all rows sends one row a task."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    rows = classes(keyed, partial(shingles, width=width), partial(_banded, percent), percent, also=("digest",)).filter("n_items > 0")
    keys = rows.groupBy("root", F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest")).agg(F.count("*").alias("n"))
    order = F.struct(F.col("of_id").isNull().alias("unknown"), "of_id", "of_digest")
    best = keys.groupBy("root").agg(F.min(order).alias("best"))
    marked = keys.join(best, "root").withColumn("is_best", order.eqNullSafe(F.col("best")))
    treated = written(marked.filter("not is_best or n > 1").select("of_id", "of_digest", "is_best"), "jaccard-treated")
    digest = F.xxhash64(docs["text"])

    def at(found: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(found["of_id"]) & (digest == found["of_digest"])

    alone = docs.join(treated, at(treated), "left_anti")
    repeated = treated.filter("is_best")
    if repeated.isEmpty():
        return alone
    every = docs.join(repeated, at(repeated), "left_semi").withColumn("_of_digest", F.xxhash64("text"))
    return alone.unionByName(every.dropDuplicates(["doc_id", "_of_digest"]).drop("_of_digest"))
