"""SpotSigs fingerprints: chains of content words behind common-word anchors.

Every anchor word of a text starts a signature: the anchor and the next CHAIN words that are no anchors. The fingerprint
is the set of 64-bit hashes of all signatures, written as sorted hexadecimal numbers. Where none of the GAP words before
a word is common, as before the first common word or in a language without listed words, the word itself is an anchor;
so the rule is one for texts of all sizes, and an edit changes only signatures near it. A text without any signature, of
a few words, has one for all its words, one without words for all its characters, and an empty text none. Likeness is
the Jaccard similarity of two sets, 1 for two empty ones.

`near_classes` compares all documents. Equal fingerprints are one node from the start. Fingerprints are put into bands by
set length, so that only sets of one or of neighbouring bands can be similar; a set is indexed in its own band and, if
its length allows, in the band below. Two sets whose similarity reaches t share one of the n - ceil(t * n) + 1 first
signatures of each in any common order; the order is by frequency, so sets meet at their rarest signatures. Frequencies
are counted over all documents in 2^RANK_BITS buckets of the hash; signatures of one bucket are ordered by hash, so the
order is common to all sets and nothing is missed. What meets goes the way of `jaccard.classes`: pairs whose lengths and
sketches allow the similarity are verified exactly, signatures that many sets share are split into blocks, and linked
nodes become classes through `components`.

Defined cases: a missing text counts as empty; a missing id orders below all others; rows that repeat an id are ordered
by text; words and texts of any length are read whole; an empty table gives an empty result; other columns are ignored.
"""

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.llm import jaccard
from patronage.llm.common import map_batches, type_of, whole_text

#: Content words in a signature.
CHAIN = 2
#: Words without a common one among them behind which every word is an anchor.
GAP = 8
#: Jaccard similarity, in hundredths, from which two documents are of one class.
NEAR = 80
#: Bits of the hash by which frequencies are counted.
RANK_BITS = 18

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it not of on or she that the they this to was
    we were which with you
    am auf aus bei das dem den der des die ein eine einen einer er es für ich ihr im ist mit nicht sich sie sind und von
    war wie wir zu
    au aux avec ce dans de du elle en est et il ils je la le les leur lui mais ne nous ou par pas plus pour qui que sa
    se ses son sur un une vous
    al como con del el ella las lo los más no o para pero por su sus una y ya
    """.split()
)

_WORDS = re.compile(r"[^\W_]+")


def signatures(text: str | None, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct hashes of the text's signatures."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    words = _WORDS.findall(text.lower())
    content = [w for w in words if w not in anchors]
    found, at, last, since = set(), 0, len(content) - chain, GAP
    for word in words:
        common = word in anchors
        at += not common
        if (common or since >= GAP) and at <= last:
            found.add(" ".join((word, *content[at : at + chain])))
        since = 0 if common else since + 1
    if not found:
        found = {" ".join(words) or text}
    digest = xxhash.xxh64_intdigest
    return np.sort(np.fromiter((digest(s) for s in found), dtype=np.uint64, count=len(found)))


def as_text(found: np.ndarray) -> str:
    """Hexadecimal numbers of 16 digits, one behind the other."""
    return found.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 without a look at the members if lengths rule out `least`."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _place(bounds: list, key: Column) -> Column:
    """How many bounds lie at or below a key, by halving."""
    if not bounds:
        return F.lit(0)
    half = len(bounds) // 2
    bound = F.struct(bounds[half][0].alias("doc_id"), F.lit(bounds[half][1]).alias("tie"))
    above = _place(bounds[half + 1 :], key) + F.lit(half + 1) if bounds[half + 1 :] else F.lit(half + 1)
    return F.when(key < bound, _place(bounds[:half], key)).otherwise(above)


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, next_text) with the text of the next lower id, and of the highest behind the lowest.

    Rows are cut into ranges of id and text digest at the quantiles of a sample, a few ranges for each shuffle partition,
    so that an id (or none) on many texts is cut too. Each range also gets the highest row of the range below, so that
    every row finds its successor inside its range; texts move once.
    """
    spark, kind = docs.sparkSession, type_of(docs, "doc_id")
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    # Of one id the least digest is the first on the way down. A missing id lies below all, as in the order of structs.
    key = F.struct("doc_id", F.bitwise_not("tie").alias("tie"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, 20 * ranges / max(docs.count(), 1))
    sample = rows.sample(share, 1).select(key.alias("key")).select("key.*").distinct().collect()  # about 20 keys a range
    sample.sort(key=lambda r: (r.doc_id is not None, r.doc_id if r.doc_id is not None else 0, r.tie))
    picked = sorted({len(sample) * k // ranges for k in range(1, ranges)}) if sample else []
    place = _place([(F.lit(sample[k].doc_id).cast(kind), sample[k].tie) for k in picked], key)
    highest = {r["bucket"]: r["top"] for r in rows.groupBy(place.alias("bucket")).agg(F.max(key).alias("top")).collect()}  # a row a range
    order = sorted(highest)
    above = dict(zip(order, order[1:] + order[:1], strict=True))
    guests = spark.createDataFrame(
        [(k, highest[k], above[k]) for k in order], f"bucket int, top struct<doc_id: {kind}, tie: long>, guest_of int"
    )
    placed = rows.withColumn("bucket", place)
    tops = F.broadcast(guests)  # a row a range
    joined = placed.join(tops, "bucket").withColumn("is_top", key.eqNullSafe(F.col("top")))
    places = F.when(F.col("is_top"), F.array(F.struct(F.col("bucket").alias("at"), F.lit(0).alias("guest")), F.struct(F.col("guest_of").alias("at"), F.lit(1).alias("guest")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("at"), F.lit(0).alias("guest")))
    )
    dealt = joined.select("doc_id", "text", "tie", F.explode(places).alias("p")).select("doc_id", "text", "tie", F.col("p.at").alias("bucket"), F.col("p.guest").alias("guest"))
    down = W.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "tie")
    return dealt.withColumn("next_text", F.lead("text").over(down)).filter("guest = 0").select("bucket", "doc_id", "text", "next_text")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following one, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they and the next document's are."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        last: list = [None, None]  # the next document's fingerprint is mostly wanted again at once

        def signed(text: str) -> np.ndarray:
            if last[0] != text:
                last[:] = [text, signatures(text)]
            return last[1]

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
            for text, following in zip(batch["text"], batch["next_text"], strict=True):
                text, following = text.as_py(), following.as_py()
                own = signed(text)
                changed = edited(text, following)
                other = signatures(changed)
                out["n_chars"].append(len(text))
                out["edited_sha256"].append(hashlib.sha256(changed.encode()).hexdigest())
                out["fingerprint"].append(as_text(own))
                out["edited_fingerprint"].append(as_text(other))
                out["near_edited"].append(likeness(own, other))
                out["near_next"].append(likeness(own, signed(following)))
            return {"doc_id": batch["doc_id"], **out}

        return step

    schema = f"doc_id {type_of(docs, 'doc_id')}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(with_next(docs).select("doc_id", "text", "next_text"), make, schema)


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - RANK_BITS)).astype(np.int64)


def _frequencies(docs: DataFrame) -> np.ndarray:
    """How many different fingerprints of a task, summed over tasks, hold signatures of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = np.zeros(1 << RANK_BITS, dtype=np.int64), set()
        for batch in batches:
            for text in batch["text"]:
                found = signatures(text.as_py())
                if (node := jaccard.node_of(found)) not in met:
                    met.add(node)
                    np.add.at(counts, _bucket(found), 1)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()), "n": pa.array(counts[held], pa.int64())})

    rows = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << RANK_BITS, dtype=np.int64)
    found = rows.toArrow()  # a row a bucket
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def band_keys(found: np.ndarray, frequency: np.ndarray, bands: jaccard.Bands) -> np.ndarray:
    """Index keys of a fingerprint: its rarest signatures, in its own length band and, if that can hold similar sets, in
    the band below."""
    n = len(found)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    prefix = n - -(-n * bands.percent // 100) + 1
    rarest = found[np.lexsort((found, frequency[_bucket(found)]))[:prefix]]
    own = bands.of(n)
    places = [k for k in (own, own - 1) if k == own or k >= 0 and n * bands.percent <= 100 * bands.high[k]]
    with np.errstate(over="ignore"):
        return np.concatenate([jaccard._mixed(rarest + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)) for k in places])


def near_classes(docs: DataFrame, percent: int = NEAR) -> DataFrame:
    """doc_id, n_signatures and class_id of every row: the least id of the documents that links of similar fingerprints
    reach from it. Documents with an empty fingerprint are alike; a missing id counts only where a class has no other.
    Rows of one class also share `root`, which tells classes without an id apart."""
    held = docs.sparkSession.sparkContext.broadcast(_frequencies(docs).astype(np.uint32))

    def make_keys() -> Callable[[np.ndarray], np.ndarray]:
        return partial(band_keys, frequency=held.value, bands=jaccard.Bands(percent))

    rows = jaccard.classes(docs, signatures, make_keys, percent)
    least = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "root").select("doc_id", F.col("n_items").alias("n_signatures"), "class_id", "root")
