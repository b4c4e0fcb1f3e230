"""Checked queries over text datasets: validation, encoding, statistics, quality, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.functions.text import (
    ENGLISH_STOP_WORDS,
    STRIP_PATTERN,
    TERM_PATTERN,
    TOKEN_PATTERN,
    WORD_PATTERN,
    word_count,
)
from tallywatch.operators import datasets, quality, requests, texts, validation
from tallywatch.operators.drift_text import add_terms
from tallywatch.plans.registry import query, settled
from tallywatch.sources.canonical import Tables

WORDS = f"CAST(len(regexp_extract_all(text, '{WORD_PATTERN}')) AS BIGINT)"
STRIPPED = f"regexp_replace(text, '{STRIP_PATTERN}', '', 'g')"
TOKENS = f"regexp_extract_all(lower(text), '{TOKEN_PATTERN}')"
STOPS = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH_STOP_WORDS) + "]"
CLEAN_WORDS = f"list_filter(regexp_extract_all(lower(text), '{TERM_PATTERN}'), lambda w: NOT list_contains({STOPS}, w))"


def grams(words: str) -> str:
    """SQL list of the words and their neighbouring pairs."""
    return f"list_concat({words}, list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


VOCABULARY_SIZE = 1000
VOCABULARY = f"""vocabulary AS (SELECT token, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS INT) AS token_id
    FROM (SELECT unnest({TOKENS}) AS token FROM labelled_texts WHERE split = 'train') GROUP BY token
    ORDER BY count(*) DESC, token LIMIT {VOCABULARY_SIZE})"""


REFERENCE_TOKENS = f"""reference_tokens AS (SELECT DISTINCT unnest({TOKENS}) AS token FROM labelled_texts WHERE split = 'train')"""


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


def _train_vocabulary(t: Tables):
    return texts.build_vocabulary(t.labelled_texts.filter(F.col("split") == "train"), VOCABULARY_SIZE)


@query("P5_word_count", "", f"SELECT doc_id, {WORDS} AS word_count FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", word_count(F.col("text")).alias("word_count"))


@query(
    "P6_text_validation",
    "",
    f"""WITH r AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN 'missing' WHEN length(text) < 1 THEN 'too_short'
        WHEN length(text) > 5000 THEN 'too_long' WHEN length({STRIPPED}) = 0 THEN 'blank' END AS reason FROM documents)
    SELECT doc_id, reason, CASE WHEN reason IS NULL THEN sha256({STRIPPED}) END AS clean_hash FROM r""",
)
def _(t: Tables):
    checked = validation.validate_texts(t.documents)
    return checked.select("doc_id", "reason", F.sha2("clean_text", 256).alias("clean_hash"))


@query(
    "P6_batch_validation",
    "text_batches",
    f"""SELECT request_id, CASE WHEN len(texts) < 1 THEN 'too_few' WHEN len(texts) > 100 THEN 'too_many'
      WHEN len(list_filter(texts, lambda text: length({STRIPPED}) = 0)) > 0 THEN 'blank_item' END AS reason,
      CAST(len(texts) AS BIGINT) AS size FROM text_batches""",
)
def _(t: Tables):
    checked = validation.validate_batches(t.text_batches)
    return checked.select("request_id", "reason", F.size("texts").cast("bigint").alias("size"))


@query(
    "P7_batch_items",
    "text_batches",
    f"""WITH i AS (SELECT request_id AS batch_id, total_time_ms / len(texts) AS ms, unnest(range(len(texts))) AS item,
        unnest(texts) AS text FROM text_batches)
    SELECT batch_id || '_' || item AS request_id, CAST(length(text) AS BIGINT) AS text_length,
      {settled("ms")} AS prediction_time_ms FROM i""",
)
def _(t: Tables):
    items = validation.batch_items(t.text_batches).select(
        "request_id", F.length("text").cast("bigint").alias("text_length"), "prediction_time_ms"
    )
    return _settle(items, "prediction_time_ms")


@query(
    "P8_P9_softmax_scores",
    "logits",
    """WITH e AS (SELECT vec_id, exp(z0 - greatest(z0, z1)) AS e0, exp(z1 - greatest(z0, z1)) AS e1 FROM logits)
    SELECT vec_id, CASE WHEN e1 > e0 THEN 1 ELSE 0 END AS predicted_label,
      CASE WHEN e1 > e0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS predicted_sentiment,
      round(greatest(e0, e1) / (e0 + e1), 4) AS confidence_score, round(e0 / (e0 + e1), 4) AS negative,
      round(e1 / (e0 + e1), 4) AS positive FROM e""",
)
def _(t: Tables):
    from tallywatch.operators.scoring import score_logits

    return score_logits(t.logits, ["z0", "z1"]).select(
        "vec_id", "predicted_label", "predicted_sentiment", "confidence_score",
        F.col("probabilities")[0].alias("negative"), F.col("probabilities")[1].alias("positive"),
    )


@query(
    "P15_J7_encoded_texts",
    "labelled_texts",
    f"""WITH {VOCABULARY},
      w AS (SELECT doc_id, label, split, ({TOKENS})[1:512] AS toks FROM labelled_texts),
      x AS (SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS at FROM w),
      c AS (SELECT x.doc_id, string_agg(CAST(coalesce(v.token_id, 1) AS VARCHAR), ',' ORDER BY x.at) AS ids
        FROM x LEFT JOIN vocabulary v ON v.token = x.token GROUP BY 1)
    SELECT w.doc_id, label, split, coalesce(c.ids, '') AS ids, CAST(least(len(toks), 512) AS BIGINT) AS mask_sum,
      CAST(512 AS BIGINT) AS length FROM w LEFT JOIN c ON c.doc_id = w.doc_id""",
)
def _(t: Tables):
    encoded = texts.encode(t.labelled_texts, _train_vocabulary(t))
    used = F.aggregate("attention_mask", F.lit(0), lambda acc, m: acc + m)
    return encoded.select(
        "doc_id", "label", "split",
        F.array_join(F.slice(F.col("input_ids"), F.lit(1), used), ",").alias("ids"),
        used.cast("bigint").alias("mask_sum"),
        F.size("input_ids").cast("bigint").alias("length"),
    )


@query(
    "J7_vocabulary",
    "labelled_texts",
    f"WITH {VOCABULARY} SELECT token, token_id FROM vocabulary",
)
def _(t: Tables):
    return _train_vocabulary(t)


@query(
    "P17_terms",
    "",
    f"""WITH w AS (SELECT doc_id, {CLEAN_WORDS} AS words FROM documents)
    SELECT doc_id, CAST(len({grams("words")}) AS BIGINT) AS terms, md5(array_to_string({grams("words")}, '|')) AS terms_hash
    FROM w""",
)
def _(t: Tables):
    found = add_terms(t.documents, "text", output="found")
    return found.select(
        "doc_id", F.size("found").cast("bigint").alias("terms"), F.md5(F.array_join("found", "|")).alias("terms_hash")
    )


DESCRIPTORS = f"""CAST(length(text) AS BIGINT) AS text_length, {WORDS} AS word_count,
    coalesce(1 - len(regexp_extract_all(text, '\\p{{L}}')) / CAST(nullif(length(text), 0) AS DOUBLE), 0) AS non_letter_share"""


@query(
    "P18_text_descriptors",
    "labelled_texts",
    f"""WITH {REFERENCE_TOKENS}, d AS (SELECT doc_id, {DESCRIPTORS}, {TOKENS} AS toks FROM labelled_texts),
      x AS (SELECT doc_id, unnest(toks) AS token FROM d),
      k AS (SELECT doc_id, count(*) FILTER (WHERE token IN (SELECT token FROM reference_tokens)) AS known FROM x GROUP BY 1)
    SELECT d.doc_id, text_length, word_count, {settled("non_letter_share")} AS non_letter_share,
      {settled("CASE WHEN len(toks) = 0 THEN 0 ELSE 1 - known / CAST(len(toks) AS DOUBLE) END")} AS oov_share
    FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
)
def _(t: Tables):
    train = t.labelled_texts.filter(F.col("split") == "train")
    described = texts.describe(t.labelled_texts, texts.reference_tokens(train), keep=())
    return _settle(described, "non_letter_share", "oov_share")


@query(
    "P19_feedback_validation",
    "feedback",
    """SELECT prediction_id, CASE WHEN feedback_score < 0 OR feedback_score > 1 THEN 'score_out_of_range'
      WHEN length(comments) > 1000 THEN 'comment_too_long' END AS reason FROM feedback""",
)
def _(t: Tables):
    return validation.validate_feedback(t.feedback).select("prediction_id", "reason")


@query(
    "P20_constraint_violations",
    "prediction_logs",
    """WITH c AS (SELECT deployment_id, count(*) FILTER (WHERE prediction_time IS NULL) AS t,
        count(*) FILTER (WHERE confidence_score < 0 OR confidence_score > 1) AS s,
        count(*) FILTER (WHERE predicted_label NOT IN (0, 1)) AS l,
        count(*) FILTER (WHERE predicted_sentiment NOT IN ('POSITIVE', 'NEGATIVE')) AS p,
        count(*) FILTER (WHERE request_id IS NULL) AS r FROM prediction_logs GROUP BY 1)
    SELECT deployment_id, unnest(['deployment_id_missing', 'request_id_missing', 'confidence_out_of_range',
      'label_not_allowed', 'sentiment_not_allowed', 'prediction_time_missing']) AS rule,
      unnest([CAST(0 AS BIGINT), r, s, l, p, t]) AS violations FROM c""",
)
def _(t: Tables):
    return validation.violations(t.logs, validation.prediction_rules(), ["deployment_id"])


@query(
    "A9_split_statistics",
    "labelled_texts",
    f"""SELECT split, count(*) AS num_examples, {settled(f"avg({WORDS})")} AS avg_length, min({WORDS}) AS min_length,
      max({WORDS}) AS max_length FROM labelled_texts GROUP BY 1""",
)
def _(t: Tables):
    return _settle(datasets.split_statistics(t.labelled_texts), "avg_length")


@query(
    "S11_statistics_as_metrics",
    "labelled_texts",
    f"""WITH w AS (SELECT split, label, {WORDS} AS n FROM labelled_texts),
      s AS (SELECT split, CAST(count(*) AS DOUBLE) AS c, avg(n) AS a, CAST(min(n) AS DOUBLE) AS lo,
        CAST(max(n) AS DOUBLE) AS hi FROM w GROUP BY 1),
      m AS (SELECT split || '_num_examples' AS metric, c AS value FROM s
        UNION ALL SELECT split || '_avg_text_length', a FROM s UNION ALL SELECT split || '_min_text_length', lo FROM s
        UNION ALL SELECT split || '_max_text_length', hi FROM s
        UNION ALL SELECT split || '_label_' || label || '_count', CAST(count(*) AS DOUBLE) FROM w
          WHERE label IS NOT NULL GROUP BY split, label
        UNION ALL SELECT 'total_examples', CAST(count(*) AS DOUBLE) FROM w)
    SELECT metric, {settled("value")} AS value FROM m""",
)
def _(t: Tables):
    return _settle(datasets.statistics_as_metrics(t.labelled_texts), "value")


# The words of a text stand in for its ids; the mask is split after double spaces are merged, so some lengths differ.
ENCODED = """encoded AS (SELECT split, CASE WHEN lang <> 'de' THEN string_split(text, ' ') END AS input_ids,
    string_split(replace(text, '  ', ' '), ' ') AS attention_mask, label + toxic AS label FROM labelled_texts)"""


def _encoded(t: Tables):
    return t.labelled_texts.selectExpr(
        "split",
        "CASE WHEN lang <> 'de' THEN split(text, ' ') END AS input_ids",
        "split(replace(text, '  ', ' '), ' ') AS attention_mask",
        "label + toxic AS label",
    )


CHECKS = f"""WITH {ENCODED},
  c AS (SELECT split, count(*) AS n, count(*) FILTER (WHERE input_ids IS NULL) AS mi,
    count(*) FILTER (WHERE attention_mask IS NULL) AS ma, count(*) FILTER (WHERE label IS NULL) AS ml,
    count(*) FILTER (WHERE len(input_ids) <> len(attention_mask)) AS uneven,
    count(*) FILTER (WHERE label IS NULL OR label NOT IN (0, 1)) AS odd FROM encoded GROUP BY 1),
  k AS (SELECT split, 'completeness' AS check_name, 1 - (mi + ma + ml) / CAST(n * 3 AS DOUBLE) AS score, mi + ma + ml AS problems FROM c
    UNION ALL SELECT split, 'consistency', CASE WHEN uneven = 0 THEN 1.0 ELSE 0.8 END, uneven FROM c
    UNION ALL SELECT split, 'validity', CASE WHEN odd = 0 THEN 1.0 ELSE 0.7 END, odd FROM c),
  p AS (SELECT *, CASE WHEN check_name = 'completeness' THEN score > 0.95 ELSE score = 1 END AS passed FROM k)"""


@query(
    "A11_A12_A13_quality_checks",
    "labelled_texts",
    f"""{CHECKS} SELECT split, check_name AS "check", {settled("score")} AS score, passed, problems FROM p""",
)
def _(t: Tables):
    return _settle(quality.quality_checks(_encoded(t)), "score")


@query(
    "A14_quality_report",
    "labelled_texts",
    f"""{CHECKS} SELECT split, count(*) FILTER (WHERE passed) AS passed_checks, count(*) AS total_checks,
      {settled("count(*) FILTER (WHERE passed) / CAST(count(*) AS DOUBLE)")} AS quality_score,
      CAST(grouping(split) AS BIGINT) AS level FROM p GROUP BY ROLLUP (split)""",
)
def _(t: Tables):
    return _settle(quality.quality_report(_encoded(t)), "quality_score")


@query(
    "U2_unexpected_labels",
    "labelled_texts",
    f"""WITH {ENCODED} SELECT split, label FROM encoded
    EXCEPT SELECT split, label FROM (SELECT DISTINCT split FROM encoded) CROSS JOIN (VALUES (0), (1)) v(label)""",
)
def _(t: Tables):
    return quality.unexpected_labels(_encoded(t))


@query(
    "U1_union_of_splits",
    "labelled_texts",
    """SELECT doc_id, split, label FROM labelled_texts WHERE split = 'train'
    UNION ALL SELECT doc_id, split, label FROM labelled_texts WHERE split <> 'train'""",
)
def _(t: Tables):
    parts = t.labelled_texts.select("doc_id", "split", "label")
    return parts.filter("split = 'train'").unionByName(parts.filter("split <> 'train'"))


@query(
    "S1_load_splits",
    "",
    """SELECT 'documents' AS split, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents
    UNION ALL SELECT 'benchmark', count(*), CAST(sum(length(text)) AS BIGINT) FROM benchmark
    UNION ALL SELECT 'conversations', count(*), CAST(sum(length(text)) AS BIGINT) FROM conversations""",
)
def _(t: Tables):
    from tallywatch.sources.tables import load_splits

    paths = {name: f"{t.folder}/{name}.parquet" for name in ("documents", "benchmark", "conversations")}
    loaded = load_splits(t.spark, paths, columns=["text"])
    return loaded.groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("characters")
    )


@query(
    "W10_duplicates",
    "",
    "SELECT sha256(text) AS input_hash, min(doc_id) AS kept_id, count(*) AS occurrences FROM documents GROUP BY 1",
)
def _(t: Tables):
    hashed = t.documents.select(F.sha2("text", 256).alias("input_hash"), "doc_id")
    return requests.duplicates(hashed, id_column="doc_id")


@query(
    "W10_first_of_each",
    "",
    """SELECT doc_id, sha256(text) AS input_hash, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text
      ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def _(t: Tables):
    hashed = t.documents.select("doc_id", F.sha2("text", 256).alias("input_hash"), "lang", "source")
    return requests.first_of_each(hashed, id_column="doc_id")


STRATIFIED = """SELECT doc_id, label, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY
    md5(doc_id || '-42'), doc_id) <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY {label}))
    THEN 'validation' ELSE 'train' END AS split FROM labelled_texts"""


@query("W13_stratified_split", "labelled_texts", STRATIFIED.format(label="label"))
def _(t: Tables):
    return datasets.stratified_split(t.labelled_texts.select("doc_id", "label"), "doc_id")


@query("W13_unstratified_split", "labelled_texts", STRATIFIED.format(label="1"))
def _(t: Tables):
    return datasets.stratified_split(t.labelled_texts.select("doc_id", "label"), "doc_id", label=None)


@query(
    "W13_validation_only_if_absent",
    "labelled_texts",
    # without a validation split one is carved out of train; the rest keeps its split
    f"""WITH whole AS ({STRATIFIED.format(label="label").replace("labelled_texts", "(SELECT * FROM labelled_texts WHERE split = 'train')")})
    SELECT doc_id, label, split FROM whole UNION ALL SELECT doc_id, label, split FROM labelled_texts WHERE split = 'test'""",
)
def _(t: Tables):
    without = t.labelled_texts.select("doc_id", "label", "split").filter("split <> 'validation'")
    return datasets.with_validation(without, "doc_id")


@query(
    "W14_shuffled_sample",
    "labelled_texts",
    """SELECT doc_id, split, label FROM labelled_texts WHERE split = 'train'
    ORDER BY md5(doc_id || '-42'), doc_id LIMIT 250""",
)
def _(t: Tables):
    train = t.labelled_texts.filter("split = 'train'").select("doc_id", "split", "label")
    return datasets.shuffled_sample(train, "doc_id", 250)


@query(
    "W15_reference_sample",
    "labelled_texts",
    """SELECT doc_id, split, label FROM labelled_texts WHERE split = 'validation' ORDER BY doc_id LIMIT 1000""",
)
def _(t: Tables):
    return datasets.reference_sample(t.labelled_texts.select("doc_id", "split", "label"), 1000)
