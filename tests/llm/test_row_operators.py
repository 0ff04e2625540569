"""Operators that judge or encode each row: against plain versions, and awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from cases import AWKWARD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm import bpe, importance, langid, ordinal, spotsigs, toxicity
from patronage.llm.common import id_hash, word_count

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.01"


def tokenizer_digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    back = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_bpe_equals_the_tokenizer(spark):
    rng = random.Random(3)
    pieces = ["a", "é", "  ", "\n", "\t", "'s", "'", "<|endoftext|>", "²", "½", "1", "٣", "\x1c", " ", "漢字", "ß", "😀", "_", "İ", "ⅷ", "\x00", "​", " ", "ɐ", "'ll"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(800)] + [None, "", " ", "x" * 100_000, "\n" * 3000]
    docs = spark.createDataFrame([(k if k % 50 else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = bpe.round_trip(docs, bpe.read_tokenizer(TOKENIZER), with_ids=True, block_chars=3000).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(tokenizer_digests(tokenizer, t) for t in texts)
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_bpe_of_awkward_rows(awkward, empty):
    tokenizer, definition = Tokenizer.from_file(TOKENIZER), bpe.read_tokenizer(TOKENIZER)
    rows = bpe.round_trip(awkward, definition).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r[0], tokenizer_digests(tokenizer, r[1])[0]) for r in AWKWARD)
    assert bpe.encode(empty, definition).count() == 0


def test_ranks_survive_packing():
    ranks = np.array([0, 159, 160, 16543, 16544, 2048159, 2048160, 2048161, 2**32 - 1])
    assert (bpe._unpacked_ranks(bpe._packed_ranks(ranks)) == ranks).all()


def chains_by_hand(text):
    """Signatures of a text as strings: each anchor with the next two words that are none."""
    words = re.findall(r"[^\W_]+", text.lower())
    out = set()
    for k, word in enumerate(words):
        plain = not any(w in spotsigs.ANCHORS for w in words[max(0, k - spotsigs.GAP) : k])
        far = plain and (k >= spotsigs.GAP or not any(w in spotsigs.ANCHORS for w in words[:k]))
        behind = [w for w in words[k + 1 :] if w not in spotsigs.ANCHORS][:2]
        if (word in spotsigs.ANCHORS or far) and len(behind) == 2:
            out.add(" ".join([word, *behind]))
    return out or ({" ".join(words) or text} if text else set())


def test_spotsigs_signatures_equal_plain_chains():
    rng = random.Random(11)
    for _ in range(400):
        share = rng.choice([0, 0.02, 0.1, 0.4, 1])
        text = " ".join(rng.choice(["the", "of", "una", "der"]) if rng.random() < share else f"W{rng.randrange(60)}," for _ in range(rng.choice([0, 1, 2, 3, 8, 9, 20, 80])))
        hashed = sorted(xxhash.xxh64_intdigest(s) for s in chains_by_hand(text))
        assert spotsigs.signatures(text).tolist() == hashed


def spotsigs_by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        sets = [{int(s) for s in spotsigs.signatures(t)} for t in (text, changed, following)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        yield doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *map(spotsigs.as_text, map(spotsigs.signatures, (text, changed))), *near


def test_spotsigs_equal_a_plain_version(spark):
    rng = random.Random(5)
    words = ["the", "of", "and", "cat", "dog", "house", "Tree.", "is", "a", "river", "über"]
    rows = [(k * 7 % 101, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 9, 60])))) for k in range(101)] + [(500, None), (None, "the last one is of no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in spotsigs.compare_with_edit(docs).collect()} == set(spotsigs_by_hand(rows))


def test_spotsigs_of_text_ids_and_one_id_on_many_texts(spark):
    rows = [(f"id{k % 7:02}" if k % 3 else None, f"the text of number {k} and a few more words {k * k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(6)
    found = spotsigs.with_next(docs).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    following = {r.text: r.next_text for r in found}
    at, seen = rows[0][1], []
    for _ in rows:  # one ring through all texts
        seen.append(at)
        at = following[at]
    assert at == seen[0] and len(set(seen)) == len(rows)
    ids = dict((t, d) for d, t in rows)
    steps = [(ids[a], ids[b]) for a, b in zip(seen, seen[1:] + seen[:1], strict=True)]
    assert sum((a or "") < (b or "") for a, b in steps) == 1  # up only once, from the last to the first


def test_spotsigs_signatures_are_anchored_chains():
    one, other = spotsigs.signatures("The quick fox of dark woods ran, and a hare at the pond slept. It was late by the sea."), spotsigs.signatures("the QUICK fox of dark woods ran and a hare at the pond slept it was late by the sea")
    assert (one == other).all() and len(one) >= 5
    assert spotsigs.likeness(one, one[:0]) == 0 and spotsigs.likeness(one[:0], one[:0]) == 1
    assert spotsigs.likeness(one, one[:2], least=0.9) == 0


def test_spotsigs_of_awkward_rows(awkward, empty):
    rows = spotsigs.compare_with_edit(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert spotsigs.compare_with_edit(empty).count() == 0


def near_classes_by_hand(rows, percent):
    sets = [(doc_id, frozenset(spotsigs.signatures(text).tolist())) for doc_id, text in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:k]):
            if a == b or 100 * len(a & b) >= percent * len(a | b):
                parent[root(k)] = root(j)
    least = {}
    for k, (doc_id, _) in enumerate(sets):
        known = least.get(root(k))
        least[root(k)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return Counter((doc_id, len(s), least[root(k)]) for k, (doc_id, s) in enumerate(sets))


@pytest.mark.parametrize("percent", [44, 80])
def test_near_classes_equal_brute_force(spark, percent):
    """Near copies far apart in id order, equal rows, empty texts, rows without an id, and a group larger than FEW that
    shares its rarest signatures without being one class."""
    rng = random.Random(percent)
    joints = ["the", "of", "and", "is", "a"]
    sentence = lambda n: [w for k in range(n) for w in (rng.choice(joints), f"w{rng.randrange(400)}", f"w{rng.randrange(400)}")]
    texts = []
    for n in (2, 4, 8, 15, 30, 60, 120):
        for _ in range(6):
            base = sentence(n)
            for _ in range(rng.choice([1, 2, 5])):
                text = list(base)
                for _ in range(rng.randrange(1 + n // 6)):
                    text[rng.randrange(len(text))] = f"v{rng.randrange(1000)}"
                texts.append(" ".join(text))
    base = sentence(40)
    for k in range(30):
        text = list(base)
        if k % 2:
            text[1::9] = [f"z{j}" for j in range(len(text[1::9]))]
        text[3 * k + 2] = f"own{k}"
        texts.append(" ".join(text))
    texts += [None, "", texts[0], texts[0], " \n"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, "only the one text of no id"), (7, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = Counter((r.doc_id, r.n_signatures, r.class_id) for r in spotsigs.near_classes(docs, percent).collect())
    assert found == near_classes_by_hand(rows, percent)


def test_near_classes_of_awkward_rows(awkward, empty):
    rows = spotsigs.near_classes(awkward).collect()
    assert len(rows) == len(AWKWARD) and {r.class_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert spotsigs.near_classes(empty).count() == 0


@pytest.mark.parametrize("learn", [ordinal.learn, toxicity.learn])
def test_samples_hold_one_text_an_id(spark, learn):
    """A labelled id on many rows weighs like any other, and its row with the least text digest is the one."""
    rows = [(k, f"good words of {k}" if k % 2 else f"idiot junk {k}") for k in range(40)]
    repeated = rows + [rows[3]] * 200
    marks = spark.createDataFrame([(k, k % 2, 1 - k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    one, other = (learn(spark.createDataFrame(r, "doc_id long, text string").repartition(3), marks, F.lit(True)) for r in (rows, repeated))
    assert one.keys() == other.keys() and all(np.array_equal(one[k], other[k]) for k in one)


def test_rare_toxic_words_are_learned(spark):
    """A word in 12 of 800 toxic documents and in no clean one is a term; one in two of them is not."""
    rows = [(k, f"idiot text {'grumpkin' if k < 12 else 'hoverly' if k < 14 else 'plain'}" if k < 800 else "a plain text") for k in range(4000)]
    marks = spark.createDataFrame([(k, 1, int(k < 800)) for k in range(4000)], "doc_id long, quality int, toxic int")
    found = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), marks, F.lit(True))["lexicon"]
    assert {toxicity.fold("idiot"), toxicity.fold("grumpkin")} <= found.keys() and toxicity.fold("hoverly") not in found


def base_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts, covered, seen, repeated = Counter(windows), set(), set(), 0
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update((k, k + 1, k + 2))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules_equal_a_plain_version(spark):
    rng = random.Random(1)
    pieces = ["a ", "b", "c\n", " ", "\t", "é", "#", "x\n", "\x0b", "\x1c", "😀 ", "the "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 300))) for _ in range(300)] + [r[1] for r in AWKWARD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r[0]: tuple(r)[1:] for r in importance.base_rules(docs).select("doc_id", *BASE).collect()}
    assert rows == {k: base_by_hand(t) for k, t in enumerate(texts)}


def test_importance_weights_equal_a_plain_count(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None)], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,)], "trusted_id long")
    weights = importance.bucket_weights(docs, trusted, bits=8)
    hashed = spark.sql("SELECT xxhash64('a') a, xxhash64('b') b, xxhash64('c') c, xxhash64(xxhash64('a'), xxhash64('b')) ab, xxhash64(xxhash64('b'), xxhash64('a')) ba, xxhash64(xxhash64('b'), xxhash64('c')) bc").first().asDict()
    good, raw = Counter(hashed[g] & 255 for g in ("a", "b", "a", "ab", "ba")), Counter(hashed[g] & 255 for g in ("a", "b", "a", "ab", "ba", "b", "c", "bc"))
    expected = [np.log((good[k] + 1) / (5 + 256)) - np.log((raw[k] + 1) / (8 + 256)) for k in range(256)]
    assert np.allclose(weights, expected)


def test_importance_of_awkward_rows(awkward, empty, labels, no_labels):
    model = importance.learn(awkward, labels)
    rows = importance.judge(awkward, model).collect()
    assert Counter(r.n_words for r in rows) == Counter(base_by_hand(r[1])[0] for r in AWKWARD)
    assert not any(r.kept for r in rows if r.base_failed)
    rows = importance.judge(awkward, importance.learn(awkward, no_labels)).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert importance.judge(empty, importance.learn(empty, no_labels)).count() == 0


def test_folding_and_exceptions():
    assert toxicity.fold("IDIOT") == toxicity.fold("1d10t") == toxicity.fold("іdі0t") == toxicity.fold("ïdi​ot") == toxicity.fold("id!ot")
    matcher = toxicity.Matcher({toxicity.fold("trash"): 2.0, toxicity.fold("loser"): 1.0}, [toxicity.fold("trash can")])
    assert matcher.weigh("You 7rash, L0SER!") == (3.0, 3)
    assert matcher.weigh("a trash\n can is no trashy thing")[0] == 0.0
    assert matcher.weigh("")[0] == 0.0


def test_few_labels_teach_terms(spark):
    """A word in all of seven toxic documents and no clean one is a term; the floor rises with the words tested."""
    rows = [(k, f"xy grumpkin said {k}" if k < 7 else f"a plain text of {k}") for k in range(130)]
    marks = spark.createDataFrame([(k, 1, int(k < 7)) for k in range(130)], "doc_id long, quality int, toxic int")
    found = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), marks, F.lit(True))["lexicon"]
    assert {"xy", toxicity.fold("grumpkin")} <= found.keys()
    assert 23 < toxicity.evidence_floor(1_000_000) < 25 and 11 < toxicity.evidence_floor(2000) < 13


def test_exceptions_of_a_long_text_equal_a_plain_filter():
    rng = random.Random(4)
    for _ in range(200):
        spans = sorted(((a := rng.randrange(60), a + rng.randrange(9)) for _ in range(rng.randrange(8))), key=lambda s: s[1])
        hits = [(a := rng.randrange(60), a + rng.randrange(5), 1.0) for _ in range(20)]
        assert toxicity._outside(hits, spans) == [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b in spans)]
    matcher = toxicity.Matcher({"trash": 2.0}, ["trash", "trash can"])
    assert matcher.weigh("trash trash can " * 30_000)[0] == 0.0


def test_toxicity_finds_held_out_rows(spark):
    docs, marks = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.learn(docs, marks, id_hash() % 3 != 1)
    rows = toxicity.score(docs, model).filter(id_hash() % 3 == 1).join(marks, "doc_id").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_toxicity_of_awkward_rows(awkward, empty, labels, no_labels):
    for marks in (labels, no_labels):
        rows = toxicity.score(awkward, toxicity.learn(awkward, marks, F.lit(True))).collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert toxicity.score(empty, toxicity.learn(empty, no_labels, F.lit(True))).count() == 0


def test_quality_finds_held_out_rows(spark):
    docs, marks = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = ordinal.learn(docs, marks, id_hash() % 4 != 0)
    assert model["thresholds"] == sorted(model["thresholds"])
    rows = ordinal.score(docs, model).filter(id_hash() % 4 == 0).join(marks, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.25 * len(bad)
    clean, toxic = [[r.expected_grade for r in rows if r.quality and r.toxic == t] for t in (0, 1)]
    assert np.mean(clean) > np.mean(toxic)


def test_quality_fit_follows_the_gradient():
    rng = np.random.default_rng(1)
    line = rng.normal(size=400)
    grades = (line > -0.5).astype(int) + (line > 0.8)
    model = ordinal.fit([(np.array([7, 9], dtype=np.int32), np.array([x, 1.0], dtype=np.float32)) for x in line], grades)
    tails = 1 / (1 + np.exp(-(model["weights"][7] * line + model["weights"][9])[:, None] + model["thresholds"]))
    assert ((tails > 0.5).sum(axis=1) == grades).mean() > 0.95


def test_quality_of_awkward_rows(awkward, empty, labels, no_labels):
    rows = ordinal.score(awkward, ordinal.learn(awkward, labels, F.lit(True))).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.tail_probability <= 1 for r in rows)
    kept = ordinal.keep(awkward, ordinal.learn(awkward, no_labels, F.lit(True)))
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
    assert ordinal.keep(empty, ordinal.learn(empty, no_labels, F.lit(True))).count() == 0


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held_out = langid.in_fold(5, 0)
    rows = langid.identify(docs, langid.learn(docs, ~held_out)).filter(held_out).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def plain_language(texts, sample):
    """Language and score of every text, from counts kept in plain dictionaries, one language at a time."""
    counts = {}
    for lang, text in sample:
        for word in regex.findall(r"\p{L}+", (text or "").lower()):
            keys = [(0, word)] + [(k, word[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(word) - k + 1)]
            counts.setdefault(lang, Counter()).update(keys)
    known = set().union(*counts.values()) if counts else set()
    sizes = Counter(size for size, _ in known)
    totals = {(lang, k): sum(n for (size, _), n in c.items() if size == k) + sizes[k] / 2 for lang, c in counts.items() for k in range(5)}

    def score_of(lang, word):
        def part(key):
            return math.log((counts[lang][key] + 0.5) / totals[lang, key[0]])

        if (0, word) in known:
            return part((0, word))
        at, parts = 0, []
        while at < len(word):
            size = next((k for k in (4, 3, 2, 1) if at + k <= len(word) and (k, word[at : at + k]) in known), None)
            parts.append(math.log(1e-7) if size is None else part((size, word[at : at + size])) - 0.9 * (4 - size))
            at += size or 1
        return sum(parts) / len(parts)

    out = []
    for text in texts:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not counts or not any(c.isalpha() for w in words for c in w):
            out.append(("und", 0.0))
            continue
        means = {lang: sum(score_of(lang, w) for w in words) / len(words) * len(words) ** 0.5 for lang in sorted(counts)}
        best = max(means, key=means.get)
        out.append((best, 1 / sum(math.exp(m - means[best]) for m in means.values())))
    return out


def test_language_equals_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held_out = langid.in_fold(5, 0)
    rows = langid.identify(docs, langid.learn(docs, ~held_out)).withColumn("held_out", held_out).collect()
    raw = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    plain = plain_language([raw[r.doc_id][1] for r in rows], [raw[r.doc_id] for r in rows if not r.held_out and raw[r.doc_id][0] is not None])
    assert len(rows) == len(raw) and [r.lang_pred for r in rows] == [lang for lang, _ in plain]
    assert [r.score for r in rows] == pytest.approx([score for _, score in plain], abs=1e-3)


def test_language_learns_every_word_of_many_languages(spark):
    # 300 languages of 40 words of their own, each seen once: no word is too rare and no language one too many.
    texts = {f"l{k:03d}": " ".join("".join(chr(97 + int(c)) for c in f"{k * 40 + i:07d}") for i in range(40)) for k in range(300)}
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(texts.items())], "doc_id long, text string, lang string")
    model = langid.learn(docs, F.lit(True))
    assert len(model["languages"]) == 300 and len(model["tables"][0]["digests"]) == 12_000 == len(model["tables"][0]["place"])
    parts = docs.withColumn("text", F.explode(F.split("text", " ")))
    rows = langid.identify(parts.withColumnsRenamed({"doc_id": "id", "lang": "doc_id"}), model).collect()
    assert len(rows) == 12_000 and all(r.lang_pred == r.doc_id for r in rows)


def test_language_backs_off_to_n_grams():
    counts = [("de", 0, "und", 5), ("en", 0, "and", 5), ("de", 3, "sch", 4), ("en", 3, "ing", 4), ("de", 1, "s", 2), ("en", 1, "i", 3)]
    model = {"languages": ["de", "en"], "tables": langid._tables([dict(zip(("lang", "size", "key", "n"), c, strict=True)) for c in counts], ["de", "en"])}
    scorer = langid.Scorer(model)
    assert langid._predicted("UND", model, scorer)[0] == "de" and langid._predicted("ing schon ing ing", model, scorer)[0] == "en"
    assert scorer.unseen("sching").argmax() in (0, 1) and scorer.unseen("schsch").argmax() == 0
    assert langid._predicted("12 ² !", model, scorer) == ("und", 0.0) and langid._predicted(None, model, scorer) == ("und", 0.0)


def test_language_of_awkward_rows(awkward, empty):
    rows = langid.identify(awkward, langid.learn(awkward, F.lit(True))).collect()
    assert Counter(r.lang_pred for r in rows)["und"] == sum(not re.search(r"[^\W\d_]", r[1] or "") for r in AWKWARD)
    unlearned = langid.identify(awkward, langid.learn(empty, F.lit(True))).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)} and langid.identify(empty, langid.learn(empty, F.lit(True))).count() == 0


def test_id_hash_and_word_count(awkward):
    rows = awkward.select("doc_id", id_hash().alias("h"), "text", word_count().alias("n")).collect()
    assert all(r.h == crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) for r in rows)
    assert all(r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows)


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", " a b\x0b\x0cc "])
def test_word_count_of_ends(spark, text):
    assert spark.createDataFrame([(text,)], "text string").select(word_count()).first()[0] == len(text.split(" ".strip() or None))


def test_every_trusted_document_counts(spark):
    """More good labels than the 20,000 that were once sampled, and the exact share of them for the threshold."""
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    trusted = importance.trusted_ids(labels)
    assert trusted.count() == 20_500
    weights = importance.bucket_weights(docs, trusted, bits=8)
    assert max(map(abs, weights)) < 1e-9  # trusted and raw are the same documents


@pytest.mark.parametrize("n, below", [(1, 0.0005), (10, 0.25), (11, 0.1), (4001, 0.0005), (7, 1.0)])
def test_threshold_is_the_exact_percentile(spark, n, below):
    ratios = spark.range(n).select(F.sin(F.col("id").cast("double")).alias("ratio"))
    assert importance._reached(ratios, below) == pytest.approx(ratios.agg(F.percentile("ratio", F.lit(below))).first()[0], abs=1e-12)
    assert importance._reached(ratios.limit(0), below) is None


def test_op7_trusted_ids_are_never_held_whole(spark):
    docs = spark.createDataFrame([("a", "x y"), ("b", None)], "doc_id string, text string")
    marked = importance.marked_texts(docs, spark.createDataFrame([("a",)], "trusted_id string"))
    assert "Broadcast" not in marked._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["is_trusted"] for r in marked.collect()) == [0, 1]
