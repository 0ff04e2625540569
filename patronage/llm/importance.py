"""Quality rules: text statistics, and the log-likelihood ratio of hashed n-grams between trusted and raw text.

Words and word pairs are hashed into 2 ** BITS buckets. Two multinomials over the buckets, one of the trusted documents
and one of the whole corpus, give each bucket a log ratio; a document's ratio is their mean over its n-grams. A document
is kept if it passes the base rules and its ratio reaches the threshold, which is set once: the ratio that all but a
small share of the trusted documents reach.

Counts cover every n-gram of every document, and of every document that is labelled good. Texts move at most once, to
meet the labels; ratios are made where the documents lie and meet the labels as a number an id. Only the fixed number of
bucket weights and two ratios pass the driver.

Everything is DataFrame functions on arrays within a row, so a text of any length stays in its row. Repeated windows are found by sorting 64-bit hashes of which the lower bits, as many as the
text's length needs, hold the place; equal neighbours are compared by their full hashes.

Defined cases: a missing text has no words; a text with fewer than MIN_WORDS words fails the base rules; without trusted
documents all weights are 0 and the base rules alone decide; repeated rows are judged alike; an empty table gives an
empty result; other columns are ignored.
"""

from math import ceil, floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import whole_text, written

BITS = 14
#: Share of trusted documents that may fall below the threshold.
BELOW = 0.0005
MIN_WORDS = 50
#: Per cent of words in repeated windows, at most.
MOST_REPEATED = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column) -> Column:
    """64-bit hash of each window of three words, from the words' hashes."""
    last = F.size(hashes) - 3
    joined = F.transform(F.sequence(F.lit(0), last), lambda k: F.xxhash64(F.get(hashes, k), F.get(hashes, k + 1), F.get(hashes, k + 2)))
    return F.when(last >= 0, joined).otherwise(F.array().cast("array<long>"))


#: Words covered by windows that occur again, from `win`, the hashes of all windows: places of windows in hash order,
#: those with an equal neighbour, in text order, and how far each reaches before the next begins.
_REPEATED = """
CASE WHEN size(array_distinct(win)) = size(win) THEN 0L ELSE
  aggregate(
    transform(
      array(sort_array(
        transform(
          filter(
            transform(
              array(sort_array(transform(win, (h, k) -> shiftleft(shiftright(h, place_bits), place_bits) | bigint(k)))),
              ranked -> transform(ranked, (r, n) -> struct(
                int(r & (shiftleft(1L, place_bits) - 1)) AS place,
                win[int(r & (shiftleft(1L, place_bits) - 1))] = get(win, int(get(ranked, n - 1) & (shiftleft(1L, place_bits) - 1))) AS like_last,
                win[int(r & (shiftleft(1L, place_bits) - 1))] = get(win, int(get(ranked, n + 1) & (shiftleft(1L, place_bits) - 1))) AS like_next))
            )[0],
            x -> coalesce(x.like_last, false) OR coalesce(x.like_next, false)),
          x -> x.place))),
      starts -> aggregate(transform(starts, (s, n) -> least(3, coalesce(get(starts, n + 1) - s, 3))), 0L, (sum, x) -> sum + x)
    ), 0L, (sum, x) -> sum + x)
END
"""


def base_rules(docs: DataFrame) -> DataFrame:
    """All columns of docs, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed; and _hashes."""
    text = whole_text()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measured = (
        docs.withColumn("_words", words_of(text))
        .withColumn("_hashes", hashes_of(F.col("_words")))
        .withColumn("_lines", lines)
        .withColumn("win", _windows(F.col("_hashes")))
        .withColumn("place_bits", F.ceil(F.log2(F.size("_words") + 2)).cast("int"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.size(F.split(text, r"[#*$%&|<>]")).cast("long") - 1)
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.expr(_REPEATED))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return measured.withColumn("base_failed", failed).drop("win", "place_bits", "_words", "_lines")


def _bucket(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1).cast("long")).cast("int")


def _grams(hashes: Column, bits: int) -> Column:
    """Buckets of all words and word pairs. hashes must be a column, as an expression would run for every pair."""
    single = F.transform(hashes, lambda h: _bucket(h, bits))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 2), lambda k: _bucket(F.xxhash64(F.get(hashes, k), F.get(hashes, k + 1)), bits)
    )
    return F.when(F.size(hashes) >= 2, F.concat(single, pairs)).otherwise(single)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids that are labelled good."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").alias("trusted_id")).distinct()


def marked_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Word hashes of every text and 1 where it is trusted. Both sides are sorted at all sizes: the ids grow with the documents
    and are never held whole."""
    docs = docs.select("doc_id", "text")
    return docs.join(trusted.hint("merge"), docs["doc_id"] == trusted["trusted_id"], "left").select(
        hashes_of(words_of(whole_text())).alias("hashes"), F.col("trusted_id").isNotNull().cast("long").alias("is_trusted")
    )


def bucket_weights(docs: DataFrame, trusted: DataFrame, bits: int = BITS) -> list[float]:
    """Log ratio of trusted to raw probability of each bucket, each smoothed by one count for a bucket."""
    marked = marked_texts(docs, trusted)
    # The outer form, as the plain one adds a filter on the array's size that builds the array a second time.
    grams = marked.select(F.explode_outer(_grams(F.col("hashes"), bits)).alias("bucket"), "is_trusted")
    counts = grams.filter("bucket is not null").groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("is_trusted").alias("good")).collect()  # a row a bucket
    n = 1 << bits
    raw_total, good_total = sum(r["raw"] for r in counts) + n, sum(r["good"] for r in counts) + n
    weights = [0.0] * n
    if good_total > n:
        empty = log(raw_total / good_total)
        weights = [empty] * n
        for r in counts:
            weights[r["bucket"]] = log((r["good"] + 1) / good_total) - log((r["raw"] + 1) / raw_total)
    return weights


def _ratio(hashes: Column, weights: list[float], bits: int) -> Column:
    """Mean weight of the text's n-grams; 0 for a text without words. hashes must be a column."""
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")  # folded to a constant
    n = F.size(hashes)
    single = F.aggregate(hashes, F.lit(0.0), lambda s, h: s + F.get(table, _bucket(h, bits)))
    pairs = F.aggregate(
        F.sequence(F.lit(0), n - 2),
        F.lit(0.0),
        lambda s, k: s + F.get(table, _bucket(F.xxhash64(F.get(hashes, k), F.get(hashes, k + 1)), bits)),
    )
    return F.when(n >= 2, (single + pairs) / (2 * n - 1)).when(n == 1, single).otherwise(0.0)


def _reached(ratios: DataFrame, below: float) -> float | None:
    """The ratio at the share `below` of the rows in rising order, between two rows in proportion. Besides the few smallest,
    as many as the share asks for, no task holds any."""
    last = ratios.count() - 1
    if last < 0:
        return None
    place = last * below
    smallest = ratios.orderBy("ratio").limit(ceil(place) + 1)
    high, *rest = [r["ratio"] for r in smallest.orderBy(F.desc("ratio")).limit(2).collect()]
    low = rest[0] if place > floor(place) else high
    return low + (high - low) * (place - floor(place))


def learn(docs: DataFrame, labels: DataFrame, bits: int = BITS, below: float = BELOW) -> dict:
    """Bucket weights and the threshold that all but `below` of the trusted documents reach."""
    trusted = trusted_ids(labels)
    weights = bucket_weights(docs, trusted, bits)
    split = docs.select("doc_id", hashes_of(words_of(whole_text())).alias("hashes")).filter("doc_id IS NOT NULL")
    every = split.filter(F.size("hashes") >= MIN_WORDS).select("doc_id", _ratio(F.col("hashes"), weights, bits).alias("ratio"))
    ratios = written(every.join(trusted.hint("merge"), every["doc_id"] == trusted["trusted_id"]).select("ratio"), "op7-ratios")
    cut = _reached(ratios, below)
    return {"weights": weights, "threshold": float("-inf") if cut is None else cut, "bits": bits}


def judge(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, the base measures, the ratio and the verdict of every document."""
    measured = base_rules(docs.select("doc_id", "text"))
    ratio = _ratio(F.col("_hashes"), model["weights"], model["bits"])
    verdict = ~F.col("base_failed") & (F.col("ratio") >= model["threshold"])
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return measured.withColumn("ratio", ratio).select(*columns, verdict.alias("kept"), "ratio")
