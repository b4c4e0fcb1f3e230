"""The registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import (
    decontamination,
    hard_negatives,
    language_id,
    lexical_search,
    licenses,
    mixing,
    near_dedup,
    piece_codec,
    quality_classifier,
    quality_rules,
    scratch,
    token_files,
    url_filter,
    vector_search,
)

URL_RULES = (
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
)

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.oracle(),
    "op6_url_filter": url_filter.oracle(URL_RULES),
    "op9_vector_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS "rank", vec_id, score
FROM s QUALIFY "rank" <= 20""",
    "op11_lexical_search": lexical_search.ORACLE,
    "op12_decontamination": decontamination.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", language_id.held_out(2, 4))
    model = language_id.fit(docs.filter("NOT held_out"))
    return language_id.predict(docs, model, ["doc_id", "held_out"])


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", language_id.held_out(1, 3))
    labels = _table(spark, folder, "labels").filter(~language_id.held_out(1, 3)).select("doc_id", F.col("quality").alias("label"))
    model = quality_classifier.fit(docs.filter("NOT held_out"), labels)
    return quality_classifier.predict(docs, model, ["doc_id", "held_out"])


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, folder, "documents"), near_dedup.Params(width=4))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(mixing.mix(_table(spark, folder, "documents")))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"), URL_RULES)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality_rules.judge(docs, quality_rules.references(docs), keep=["doc_id"])


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return piece_codec.digest(piece_codec.encode(docs, ["doc_id"], check=True))


def op9_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return vector_search.top_k(vectors.filter("vec_id % 20 = 0"), vectors)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.folder(spark, "token-files")
    token_files.write(_table(spark, folder, "documents"), path)
    return token_files.read_back(spark.read.schema(token_files.SHARDS).parquet(path))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.rank(_table(spark, folder, "benchmark"), _table(spark, folder, "documents"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    index = decontamination.build(_table(spark, folder, "documents"))
    return decontamination.verdicts(index, decontamination.phrases(index, _table(spark, folder, "benchmark")))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings").withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives.mine(rows.filter("vec_id % 100 = 0"), rows)


_QUERIES = (
    op1_language_id,
    op2_license_scan,
    op3_quality_classifier,
    op4_near_dedup,
    op5_mixing,
    op6_url_filter,
    op7_quality_rules,
    op8_sentencepiece,
    op9_vector_search,
    op10_token_files,
    op11_lexical_search,
    op12_decontamination,
    op13_hard_negatives,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _QUERIES}
