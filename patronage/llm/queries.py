"""Queries over the given tables, one an operator, and their SQL where SQL can express them.

Each query reads its whole tables with production parameters and derives the columns of its contract from the operator's
own output.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import bpe, chunks, decontamination, importance, jaccard, langid, mixing, ordinal, resampling, sharding, spotsigs, toxicity, whitening
from patronage.llm.common import id_hash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The quality classifier learns from ids whose crc32 modulo 4 is not 0; the rest are held out.
def quality_fold():
    return id_hash() % 4 == 0


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal.learn(docs, table(spark, sf_dir, "labels"), ~quality_fold())
    return ordinal.score(docs, model).withColumn("held_out", quality_fold())


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_hash() % 3 == 1
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLES["op8_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size, 3 * source_size AS most,
    [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS place,
    (sum(source_size) OVER ())::BIGINT AS total
  FROM sources
), filled AS (
  SELECT *, most * weight_left <= (total - most_before) * weight AS is_full
  FROM (SELECT *,
    coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS most_before,
    sum(weight) OVER (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM weighted)
), levelled AS (
  SELECT *, (total - coalesce(sum(most) FILTER (is_full) OVER (), 0))::DOUBLE / (sum(weight) FILTER (NOT is_full) OVER ())::DOUBLE AS level
  FROM filled
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN most::DOUBLE ELSE level * weight END AS target FROM levelled
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT
    + (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate))::BIGINT)
    AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.in_fold(5, 0)
    return langid.identify(docs, langid.learn(docs, ~held_out)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))


@query
def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_edit(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return importance.judge(docs, importance.learn(docs, table(spark, sf_dir, "labels")))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.linked(table(spark, sf_dir, "documents"), width=3, percent=90)
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = chunks.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), spans_as="removed")
    span = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return cut.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), span.alias("n_removed"), "removed")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*map(F.lit, model.explained or [0.0]))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resampling.draw(docs, resampling.learn(docs, table(spark, sf_dir, "benchmark")))


ORACLES["op12_resampling"] = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS row_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
  UNION ALL
  SELECT 't', NULL, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), features AS (
  SELECT side, row_id, unnest(words || list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) AS feature
  FROM texts
), grouped AS (
  SELECT side, row_id, feature, count(*)::BIGINT AS n FROM features GROUP BY ALL
), crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS r(b)
), hexed AS (
  SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM grouped)
), digested AS (
  SELECT feature, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table
), counted AS (
  SELECT bucket, (sum(n) FILTER (side = 'd'))::BIGINT AS s, (sum(n) FILTER (side = 't'))::BIGINT AS t
  FROM grouped JOIN digested USING (feature) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0)::DOUBLE + 10000))))::BIGINT AS gain
  FROM counted
), weighed AS (
  SELECT row_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM grouped JOIN digested USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_id
), scored AS (
  SELECT id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weighed USING (row_id) WHERE side = 'd'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    (25 * count(*) FILTER (n_words >= 20) OVER ()) // 100 AS taken
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= taken THEN place END AS rank FROM placed
"""


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLES["op13_decontamination"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[k : k + size - 1], ' ') AS gram
  FROM (SELECT item_id, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS k FROM items WHERE len(words) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), runs AS (
  SELECT row_id, size, k, array_to_string(words[k : k + size - 1], ' ') AS gram
  FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM docs, sizes)
), hits AS (
  SELECT row_id, runs.size, k, item_id FROM runs JOIN windows ON runs.gram = windows.gram AND runs.size = windows.size
), covered AS (
  SELECT row_id, count(DISTINCT word)::BIGINT AS n_hit FROM (SELECT row_id, unnest(range(k, k + size)) AS word FROM (SELECT DISTINCT row_id, size, k FROM hits)) GROUP BY row_id
), named AS (
  SELECT row_id, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT row_id, item_id FROM hits) GROUP BY row_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row_id) LEFT JOIN named USING (row_id)
"""
