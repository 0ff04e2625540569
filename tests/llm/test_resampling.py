"""Importance resampling: against plain CRCs, plain counts and DuckDB, and awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
from cases import AWKWARD
from pyspark.sql import functions as F

from patronage.llm import queries, resampling
from patronage.llm.common import normal_words

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_features(text, width=2):
    words = plain_words(text)
    return [" ".join(words[k : k + n]) for n in range(1, width + 1) for k in range(len(words) - n + 1)]


def plain_draw(docs, target, percent=25, least=20, buckets=10_000):
    bucket = lambda f: crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, x in docs for f in plain_features(x)), Counter(bucket(f) for x in target for f in plain_features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * float(all_s + buckets) / ((s[b] + 1) * float(all_t + buckets))))
    out = []
    for doc_id, text in docs:
        gains = [gain(bucket(f)) for f in plain_features(text)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)) >= least))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    taken = percent * len(order) // 100
    return [(*r[:4], k + 1 if k < taken else None) for k, r in enumerate(order)] + [(*r[:4], None) for r in out if not r[4]]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_words_of_bytes_are_those_of_the_pattern():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "Z", "k", "é", "É", "漢", "\x00", "\x7f", "\x85", "\xa0", " ", "_", "@", "[", "`", "{", "/", ":", "0", "9", " ", "😀"]) for _ in range(rng.randrange(60)))
        assert normal_words(text.encode()) == [w.encode() for w in plain_words(text)]


def test_crcs_of_runs_equal_plain_crcs():
    rng = random.Random(3)
    texts = [[bytes(rng.choices(b"abc\xc3\xa9", k=rng.choice([1, 2, 7, 95, 96, 97, 300, 70_000 if k == 5 else 4]))) for _ in range(rng.choice([0, 1, 2, 3, 20]))] for k in range(60)]
    for n, (crcs, of_text) in enumerate(resampling.run_crcs(texts, 3), 1):
        expected = [(crc32(b" ".join(words[k : k + n])), t) for t, words in enumerate(texts) for k in range(len(words) - n + 1)]
        assert list(zip(crcs.tolist(), of_text.tolist(), strict=True)) == expected


def test_shifts_cancel_any_prefix():
    rng = np.random.default_rng(8)
    for length in (0, 1, 5, 96, 97, 1000, 123_457):
        head, tail = rng.bytes(50), rng.bytes(length)
        moved = int(resampling.shifted(np.array([crc32(head)], dtype=np.uint32), np.array([length]))[0])
        assert moved ^ crc32(head + tail) == crc32(tail)


def test_draw_equals_a_plain_one(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 40, 200])))) for k in range(400)]
    target = [" ".join(rng.choices(words[:60], k=50)) for _ in range(20)]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    right = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    found = [tuple(r) for r in resampling.draw(left, resampling.learn(left, right)).collect()]
    assert sorted(found, key=key) == sorted(plain_draw(docs, target), key=key)
    # the drawn texts hold more of the target's words
    share = lambda rows: np.mean([w in words[:60] for d in rows for w in dict(docs)[d].split()])
    assert share([r[0] for r in found if r[4]]) > share([d for d, _ in docs])


def test_query_equals_sql(spark):
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    columns = "doc_id, n_features, weight, score, rank"
    expected = duckdb.sql(f"SELECT {columns} FROM ({queries.ORACLES['op12_resampling']})").fetchall()
    rows = queries.QUERIES["op12_resampling"](spark, FOLDER).select(*columns.split(", "))
    assert all(kind == "bigint" for _, kind in rows.dtypes)
    assert sorted(map(tuple, rows.collect()), key=key) == sorted(expected, key=key)


def test_awkward_rows(awkward, empty, spark):
    awkward = awkward.withColumns({c: F.lit("x") for c in ("rank", "weight", "n_words", "n_features", "_row", "_place", "_part")})
    target = spark.createDataFrame([(1, "the cat"), (2, None), (3, "")], "item_id long, text string")
    found = [tuple(r) for r in resampling.draw(awkward, resampling.learn(awkward, target), percent=60).collect()]
    expected = plain_draw([(r[0], r[1]) for r in AWKWARD], ["the cat"], percent=60)
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert resampling.draw(empty, resampling.learn(empty, target)).count() == 0
    nothing = resampling.learn(awkward, empty.select("text"))
    assert resampling.draw(awkward, nothing).count() == len(AWKWARD)


def test_ranks_count_equal_rows_one_by_one(spark):
    rows = [(None, "same words " * 20)] * 500 + [(7, "same words " * 20)] * 500 + [(k, "other words " * 20) for k in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    ranks = [r["rank"] for r in resampling.draw(docs, resampling.learn(docs, docs.limit(1)), percent=70).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 771))
