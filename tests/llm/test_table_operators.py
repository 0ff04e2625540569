"""Operators that look across rows: against brute force, and awkward rows."""

import os
import random
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import AWKWARD, near_copies
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from patronage.llm import chunks, jaccard, mixing, queries, sharding
from patronage.llm.common import BATCH_BYTES, written
from patronage.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def test_shards_are_even_gapless_and_keep_groups(spark):
    texts = [f"text {k} " * (k % 40) for k in range(3000)] + ["a copy of a text"] * 4000 + ["twice", "twice", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sharding.byte_shards(docs, shards=7, salts=16).collect()
    size, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        places[texts[r.doc_id]].add(r.shard)
    assert len(rows) == len(texts) and set(size) == set(range(7))
    target, part = sum(size.values()) / 7, sum(size.values()) / 7 / 16
    assert all(abs(b - target) <= part + 400 for b in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(places["twice"]) == 1 and len(places["a copy of a text"]) > 1
    again = sharding.byte_shards(docs.repartition(3), shards=7, salts=16).collect()
    assert sorted(rows) == sorted(again)


def test_shards_of_awkward_rows(awkward, empty):
    rows = sharding.byte_shards(awkward, shards=3).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((r[0], len((r[1] or "").encode()) + 16) for r in AWKWARD)
    assert sharding.byte_shards(empty).count() == 0


def test_mixing_matches_sql(spark):
    for file in ("documents",):
        duckdb.sql(f"CREATE OR REPLACE VIEW {file} AS SELECT * FROM '{FOLDER}/{file}.parquet'")
    expected = duckdb.sql(queries.ORACLES["op8_mixing"]).fetchall()
    rows = queries.QUERIES["op8_mixing"](spark, FOLDER).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert [(r[0], r[1], r[2], round(r[3], 6), r[4]) for r in sorted(rows)] == [(r[0], r[1], r[2], round(r[3], 6), r[4]) for r in sorted(expected)]


def test_targets_hand_the_excess_on(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 2), (None, 50), ("z", 0)], "source string, size long")
    rows = {r.source: r for r in mixing.targets(sizes).collect()}
    # weights by code point: a 1, b 2, c 3, z 1, null 2; b, c and z fill up, the rest is shared 1 : 2
    assert rows["b"].target == 3 and rows["c"].target == 6 and rows["z"].target == 0 == rows["z"].rate
    assert rows["a"].target == pytest.approx(144 / 3) and rows[None].target == pytest.approx(2 * 144 / 3)


def test_mix_of_awkward_rows(awkward, empty):
    planned = {(r.doc_id, r["size"]): r.copies for r in mixing.plan(awkward).collect()}
    taken = mixing.mixed(awkward)
    assert taken.columns == awkward.columns and max(planned.values()) <= 3
    found = Counter(r.doc_id for r in taken.collect())
    assert all(found[k] == n for (k, _), n in planned.items() if k not in (None, 6))
    assert mixing.mixed(empty).count() == 0 and mixing.plan(empty).count() == 0


def components_by_hand(rows, width, percent):
    sets, parent, holders = {}, {}, defaultdict(list)
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[doc_id] = frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else frozenset()
        parent[doc_id] = doc_id

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc_id, items in sets.items():
        common = Counter(k for item in items for k in holders[item])
        for item in items:
            holders[item].append(doc_id)
        for other, n in common.items():
            if 100 * n >= percent * (len(items) + len(sets[other]) - n):
                a, b = sorted((root(doc_id), root(other)))
                parent[b] = a
    return {k: (len(s), root(k)) for k, s in sets.items()}


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 90), (3, 1, 80)])
def test_join_equals_brute_force(spark, seed, width, percent):
    rows = list(enumerate([*near_copies(seed, 90), None, "", "  ", "A b C", "a B c"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(docs, width, percent).collect()}
    assert found == components_by_hand(rows, width, percent)


def test_large_keys_are_settled_exactly(spark):
    """Many texts share keys without all being similar: two families that differ in a fifth of their words."""
    base = [f"v{k}" for k in range(60)]
    rows = []
    for k in range(60):
        text = list(base)
        if k % 2:
            text[::5] = [f"z{j}" for j in range(12)]
        text[(7 * k + 1) % 60] = f"own{k}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(docs, 1, 90).collect()}
    assert found == components_by_hand(rows, 1, 90)


def test_join_of_awkward_rows(awkward, empty):
    rows = jaccard.linked(awkward, 3, 90).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r.component_id == 5 for r in rows if r.doc_id in (5, 6)) and all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    kept = jaccard.one_of_each(awkward)
    assert kept.columns == awkward.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in AWKWARD if r[0] != 6)
    assert jaccard.one_of_each(empty).count() == 0


@pytest.mark.parametrize("n", [40, 160])
def test_rows_without_an_id_are_shingled_once_a_set(spark, n):
    """They meet their own set by text digest; meeting by id alone would shingle each once for every set."""
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(n)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(None, t + " more") for t in texts], "doc_id long, text string").repartition(3)
    read = spark.sparkContext.accumulator(0)

    def items_of(text):
        read.add(1)
        return jaccard.shingles(text, 2)

    members = written(jaccard.sets_of(docs.withColumn("_digest", F.xxhash64("text")), items_of, ("_digest",)), "sets")
    before = read.value
    items = jaccard._items_of(docs, members, members.select("node").distinct(), items_of, 90)
    assert written(items, "items").count() == 2 * n and read.value - before == 2 * n
    rows = jaccard.classes(docs, items_of, lambda: jaccard._banded(90), 90).groupBy("root").count().collect()
    assert sorted(r["count"] for r in rows) == [2] * n


def test_sets_are_made_again_only_where_sketches_allow_the_pair(spark):
    """Six sets meet at one key and two of them are near: these alone are made again to be compared."""
    texts = [" ".join(f"w{k}x{j}" for j in range(40)) for k in range(5)]
    docs = spark.createDataFrame([*enumerate(texts), (9, texts[0] + " more")], "doc_id long, text string").repartition(1)
    read = spark.sparkContext.accumulator(0)

    def items_of(text):
        read.add(1)
        return jaccard.shingles(text, 1)

    found = jaccard.classes(docs, items_of, lambda: lambda items: np.array([7], dtype=np.uint64), 80).collect()
    assert read.value == 6 + 6 + 2  # each set's sketch, its index keys, and the near ones
    assert len({r.root for r in found}) == 5 and len({r.root for r in found if r.doc_id in (0, 9)}) == 1


def test_candidates_equal_brute_force():
    rng = np.random.default_rng(5)
    keys, nodes = rng.integers(0, 900, 1500).astype(np.uint64), rng.integers(0, 400, 1500)
    keys[:60] = 7
    by_key = defaultdict(set)
    for key, node in zip(keys.tolist(), nodes.tolist(), strict=True):
        by_key[key].add(node)
    pairs = Counter((None, *p) for found in by_key.values() if len(found) <= jaccard.FEW for p in combinations(sorted(found), 2))
    large = Counter((key, n, n) for key, found in by_key.items() if len(found) > jaccard.FEW for n in found)
    assert large and Counter(zip(*jaccard._met_at(keys, nodes), strict=True)) == pairs + large
    assert jaccard._met_at(np.arange(5, dtype=np.uint64), np.arange(5)) == ([], [], [])


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES if name != "mixing sources"])
def test_stages_take_texts_to_python_in_small_batches(spark, stage):
    """Thirty megabytes of text came as one batch."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(20), FOLDER)
    long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("some words "), 9000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) < 1.2 * BATCH_BYTES


def test_one_row_of_each_component_stays(spark):
    """Also where an id repeats with equal or near texts, and where ids are missing."""
    text = " ".join(f"w{k}" for k in range(60))
    near, other = text + " more", " ".join(f"v{k}" for k in range(60))
    rows = [(1, text)] * 50 + [(1, near), (2, text), (None, text), (None, other), (None, other), (None, None), (3, ""), (3, ""), (4, "alone here"), (1, "another text of one")]
    found = Counter(tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    of_one = {k: n for k, n in found.items() if k in ((1, text), (1, near), (2, text), (None, text))}
    assert sum(of_one.values()) == 1 and next(iter(of_one))[0] == 1
    assert found - Counter(of_one) == Counter([(None, other), (None, None), (3, ""), (3, ""), (4, "alone here"), (1, "another text of one")])


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(14)] + [(100, k) for k in range(101, 140)] + [(139, 200), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(3)).collect()}
    assert found == {k: 0 for k in range(15)} | {k: 100 for k in [*range(100, 140), 200]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def passages(spark):
    own = lambda k, n: " ".join(f"o{k}x{j}" for j in range(n))
    passage = " ".join(f"shared{j}" for j in range(60))
    return passage, [(k, f"{own(k, 30 + k % 7)} {passage}, {own(-k, 20)}") for k in range(1, 30)] + [(50, own(50, 300)), (51, "one short line, seen twice"), (52, "one short line, seen twice")]


def test_repeated_passages_go_and_the_rest_stays(spark):
    passage, rows = passages(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in chunks.dedup(docs, spans_as="spans").collect()}
    for doc_id, text in rows:
        cut = found[doc_id]
        rest, at = [], 0
        for a, b in cut.spans:
            rest.append(text[at:a])
            at = b
        assert "".join(rest) + text[at:] == cut.text
        left = sum(w in cut.text.replace(",", "").split() for w in passage.split())
        assert left == 60 if doc_id == 1 else left <= 30 if doc_id < 30 else cut.text == text
        assert [w for w in text.split() if "x" in w] == [w for w in cut.text.split() if "x" in w]


def test_passages_are_found_in_rows_without_an_id(spark):
    passage, rows = passages(spark)
    docs = spark.createDataFrame([(1, rows[0][1]), (None, rows[1][1]), (None, rows[2][1])], "doc_id long, text string")
    found = [(r.doc_id, sum(w in r.text.replace(",", "").split() for w in passage.split())) for r in chunks.dedup(docs).collect()]
    assert len(found) == 3 and all(left == 60 if doc_id == 1 else left <= 30 for doc_id, left in found)


def test_blocks_do_not_change_what_is_cut(spark):
    _, rows = passages(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(chunks.dedup(docs.repartition(5), block_bytes=500).collect()) == sorted(chunks.dedup(docs.coalesce(1)).collect())


def test_cuts_resist_insertions():
    text = " ".join(f"word{k * k % 997}" for k in range(400)).encode()
    cuts = chunks.units_of(text)[1]
    shifted = chunks.units_of(b"some new words " + text)[1]
    assert len(set(cuts) - set(shifted)) <= chunks.WINDOW + 1


def test_no_passage_of_fifty_words_is_missed():
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(4, 9))) for _ in range(n))
    for n in [50] * 1500 + [51] * 1500:
        passage = words(n)
        known = chunks.units_of(f"{words(20)} {passage} {words(20)}".encode())[1]
        other = f"{words(25)} {passage} {words(25)}".encode()
        spans = chunks.stretches(other, known)
        assert sum(len(other[a:b].split()) for a, b in spans) >= chunks.MIN_WORDS, passage


def test_chunks_of_awkward_rows(awkward, empty):
    found = chunks.dedup(awkward)
    assert found.columns == awkward.columns
    texts = Counter((r.doc_id, r.text) for r in found.collect())
    assert texts == Counter((r[0], "" if r[0] == 6 else r[1]) for r in AWKWARD)
    assert chunks.dedup(empty).count() == 0


def test_pipeline_keeps_its_contract(spark):
    """Stage by stage as run() chains them; near duplicates go as brute force says, and all that is emitted is encoded."""
    docs, near = spark.read.parquet(f"{FOLDER}/documents.parquet"), corpus_pipeline.STAGES[1][0]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, FOLDER), "stage")
        assert out.dtypes == docs.dtypes, name
        rows, found = [(r.doc_id, r.text) for r in docs.collect()], [r.doc_id for r in out.collect()]
        assert set(found) <= {r[0] for r in rows}
        if name == near:
            assert sorted(found) == sorted(k for k, (_, least) in components_by_hand(rows, 5, 80).items() if k == least)
        docs = out
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in last) == Counter((r.doc_id, tuple(tokenizer.encode(r.text, add_special_tokens=False).ids)) for r in docs.collect())


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op5_sharding", "op7_quality_rules", "op8_mixing"])
def test_native_plans_hold_no_python(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_work_goes_to_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = len(os.listdir(folder))
    jaccard.linked(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).count()
    assert len(os.listdir(folder)) > before
