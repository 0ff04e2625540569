"""Decontamination: against a search of every window at every place, DuckDB, and awkward rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from cases import AWKWARD
from pyspark.sql import functions as F

from patronage.llm import decontamination, queries
from patronage.llm.common import normal_words

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_matches(text, items, window):
    """Places of hit words and items with occurring windows, by looking at every window of every item."""
    words = plain_words(text)
    hit, names = set(), set()
    for name, item in items:
        of_item = plain_words(item)
        size = min(window, len(of_item))
        windows = {tuple(of_item[k : k + size]) for k in range(len(of_item) - size + 1)} if size else set()
        for k in range(len(words) - size + 1 if size else 0):
            if tuple(words[k : k + size]) in windows:
                hit.update(range(k, k + size))
                names.add("" if name is None else str(name))
    return len(words), hit, names


def cases(seed, window):
    """Items and documents from few words, so that runs of any length recur, with repeated, nested and short items."""
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(rng.choice([2, 4, 30]))]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(k, text(rng.choice([0, 1, window - 1, window, window + 1, 3 * window, 60]) if rng.random() < 0.7 else 40)) for k in range(12)]
    items += [(20, items[0][1]), (21, " ".join(items[3][1].split()[1:-1])), (22, items[5][1] + " " + text(3)), (5, text(window + 2)), (None, text(window)), (30, None)]
    docs = [(k, text(rng.randrange(0, 80))) for k in range(40)]
    docs += [(100 + k, f"{text(9)}, {t} x. {text(5)}") for k, (_, t) in enumerate(items) if t]
    return docs, items


@pytest.mark.parametrize(("seed", "window"), [(1, 10), (2, 3), (3, 4), (4, 2), (5, 5)])
def test_automaton_finds_every_window(seed, window):
    docs, items = cases(seed, window)
    automaton = decontamination.Automaton([("" if n is None else str(n), normal_words((t or "").encode())) for n, t in items], window)
    assert len(automaton.steps) <= 2 * sum(len(plain_words(t)) for _, t in items) + 1
    for _, text in docs:
        n, hit, names = plain_matches(text, items, window)
        spans, found = automaton.match(normal_words(text.encode()))
        assert [k for a, b in spans for k in range(a, b)] == sorted(hit) and found == names


@pytest.mark.parametrize(("block_words", "piece"), [(200_000, 20_000), (60, 7)])
def test_matches_equal_brute_force_in_one_block_or_many(spark, block_words, piece):
    docs, items = cases(7, 4)
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    right = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.matches(left, right, window=4, block_words=block_words, piece=piece).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, names = plain_matches(dict(docs)[r.row.doc_id], items, 4)
        assert r.n_words == n and r["items"] == sorted(names)
        assert [k for s in r.spans for k in range(s.start, s.end)] == sorted(hit)


def test_hit_words_go_and_the_rest_stays(spark):
    item = " ".join(f"q{k}" for k in range(14))
    rows = [(1, f"Before, {item.upper()}! And after: {item[:-4]}."), (2, "nothing of it"), (3, f"a {item}"), (4, f"{' '.join(item.split()[:9])} too short"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("items", F.lit("own"))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r.text for r in decontamination.clean(docs, bench, most=0.9).collect()}
    assert found == {1: "Before, ! And after: .", 2: rows[1][1], 4: rows[3][1], 5: None, 6: ""}  # 3 is item but for one word
    assert decontamination.clean(docs, bench).columns == docs.columns


def test_query_equals_sql(spark):
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    columns = "doc_id, n_words, n_hit, n_items, items_sha256, contaminated"
    expected = duckdb.sql(f"SELECT {columns} FROM ({queries.ORACLES['op13_decontamination']})").fetchall()
    rows = queries.QUERIES["op13_decontamination"](spark, FOLDER).select(*columns.split(", "))
    assert [kind for _, kind in rows.dtypes] == ["bigint", "bigint", "bigint", "bigint", "string", "boolean"]
    assert sorted(map(tuple, rows.collect())) == sorted(expected)
    assert hashlib.sha256(b"").hexdigest() in {r[4] for r in expected} and any(r[5] for r in expected)


def test_awkward_rows(awkward, empty, spark):
    awkward = awkward.withColumns({c: F.lit("x") for c in ("row", "spans", "items", "n_words", "block")})
    items = [(1, "the cat sat on the mat and the dog ran to"), (1, "der hund und die katze"), (None, "word17 word18 word19"), (3, None), (4, " ?! ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = Counter((r.row.doc_id, r.n_words, tuple(r["items"])) for r in decontamination.matches(awkward, bench).collect())
    expected = Counter()
    for doc_id, text, *_ in AWKWARD:
        n, _, names = plain_matches(text, items, 10)
        expected[doc_id, n, tuple(sorted(names))] += 1
    assert found == expected
    cleaned = decontamination.clean(awkward, bench)
    assert cleaned.columns == awkward.columns and Counter(r.doc_id for r in cleaned.collect()) == Counter(r[0] for r in AWKWARD if r[0] not in (5, 6))
    assert decontamination.matches(empty, bench).count() == 0 and decontamination.clean(empty, bench).count() == 0
    assert decontamination.clean(awkward, bench.limit(0)).count() == len(AWKWARD)
