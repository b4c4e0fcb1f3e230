"""Checked queries for drift: terms, centroids, two-sample tests, concept and model drift, columns, the monitor."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.functions.sizes import scratch_folder, stored
from tallywatch.functions.text import word_count
from tallywatch.operators import drift_columns, drift_content, drift_stats, drift_text, filters, texts
from tallywatch.operators.alerts import drift_alerts
from tallywatch.operators.datasets import reference_texts
from tallywatch.operators.usage import daily_performance
from tallywatch.plans.check_texts import CLEAN_WORDS, DESCRIPTORS, REFERENCE_TOKENS, TOKENS, WORDS, grams
from tallywatch.plans.check_usage import AS_OF, RECENT_DAY, RECENT_WEEK
from tallywatch.plans.monitor import run_monitor
from tallywatch.plans.registry import query, settled
from tallywatch.sources.canonical import Tables


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


def _train(t: Tables):
    return t.labelled_texts.filter("split = 'train'").select("doc_id", "text")


def _test(t: Tables):
    return t.labelled_texts.filter("split = 'test'").select("doc_id", "text")


TFIDF = f"""WITH w AS (SELECT doc_id, split, {CLEAN_WORDS} AS words FROM labelled_texts),
  g AS (SELECT doc_id, split, unnest({grams("words")}) AS term FROM w),
  tf AS (SELECT doc_id, split, term, count(*) AS n FROM g GROUP BY 1, 2, 3),
  voc AS (SELECT term, CAST(sum(n) AS BIGINT) AS corpus_count, count(*) AS document_count,
      ln((1 + CAST((SELECT count(*) FROM w WHERE split = 'train') AS DOUBLE)) / (1 + count(*))) + 1 AS idf
    FROM tf WHERE split = 'train' GROUP BY 1 ORDER BY 2 DESC, term LIMIT 1000),
  wt AS (SELECT doc_id, split, tf.term, n * idf AS x FROM tf JOIN voc ON voc.term = tf.term),
  nm AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM wt GROUP BY 1),
  v AS (SELECT wt.doc_id, split, term, x / norm AS weight FROM wt JOIN nm ON nm.doc_id = wt.doc_id),
  means AS (SELECT voc.term, coalesce(sum(weight) FILTER (WHERE split = 'train'), 0)
      / (SELECT count(*) FROM w WHERE split = 'train') AS a, coalesce(sum(weight) FILTER (WHERE split = 'test'), 0)
      / (SELECT count(*) FROM w WHERE split = 'test') AS b
    FROM voc LEFT JOIN v ON v.term = voc.term GROUP BY 1),
  cosine AS (SELECT sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))) AS similarity FROM means)"""


@query(
    "G1_fit_terms",
    "labelled_texts",
    f"{TFIDF} SELECT term, corpus_count, document_count, {settled('idf')} AS idf FROM voc",
)
def _(t: Tables):
    return _settle(drift_text.fit_terms(_train(t)), "idf")


@query(
    "G2_term_weights",
    "labelled_texts",
    f"{TFIDF} SELECT doc_id, term, {settled('weight')} AS weight FROM v WHERE split = 'test'",
)
def _(t: Tables):
    weights = drift_text.TermWeights.fit(_train(t))
    return _settle(drift_text.term_weights(weights, _test(t)), "weight")


@query(
    "J5_reference_and_current_means",
    "labelled_texts",
    f"{TFIDF} SELECT term, {settled('a', 8)} AS reference_weight, {settled('b', 8)} AS current_weight FROM means",
)
def _(t: Tables):
    weights = drift_text.TermWeights.fit(_train(t))
    reference = drift_text.centroid_table(weights, _train(t)).withColumnRenamed("mean_weight", "reference_weight")
    current = drift_text.centroid_table(weights, _test(t)).withColumnRenamed("mean_weight", "current_weight")
    joined = reference.join(current, "term", "left").withColumn(
        "current_weight", F.coalesce("current_weight", F.lit(0.0))
    )
    return _settle(joined, "reference_weight", "current_weight", digits=8)


@query(
    "G3_centroid_drift",
    "labelled_texts",
    f"""{TFIDF} SELECT {settled('similarity')} AS cosine_similarity, {settled('1 - similarity')} AS drift_score
    FROM cosine""",
)
def _(t: Tables):
    reference = drift_text.TextReference.fit(_train(t))
    return _settle(reference.centroid_drift(_test(t)), "cosine_similarity", "drift_score")


def ks_sql(counts: str) -> str:
    """CTEs `ks_d` (keys, d, n, m) from `counts` (k, value, a, b): the two-sample distance per k."""
    return f"""ks_c AS (SELECT k, value, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY k) AS n,
        sum(b) OVER (PARTITION BY k) AS m FROM ({counts}) WINDOW w AS (PARTITION BY k ORDER BY value)),
      ks_d AS (SELECT k, max(abs(ca / CAST(n AS DOUBLE) - cb / CAST(m AS DOUBLE))) AS d, CAST(max(n) AS DOUBLE) AS n,
        CAST(max(m) AS DOUBLE) AS m FROM ks_c GROUP BY 1),
      ks AS (SELECT k, d, n, m, CASE WHEN sqrt(n * m / (n + m)) * d < 0.2 THEN 1.0 ELSE greatest(0, least(1,
        list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END)
          * exp(-2.0 * i * i * (n * m / (n + m)) * d * d))))) END AS p FROM ks_d)"""


KS_LENGTHS = ks_sql(
    f"""SELECT 0 AS k, {WORDS} AS value, count(*) FILTER (WHERE split = 'train') AS a,
    count(*) FILTER (WHERE split = 'test') AS b FROM labelled_texts GROUP BY ALL"""
)


@query(
    "G4_length_ks",
    "labelled_texts",
    f"""WITH {KS_LENGTHS} SELECT {settled("d")} AS ks_statistic, CAST(n AS BIGINT) AS n_ref, CAST(m AS BIGINT) AS n_cur,
      {settled("p")} AS p_value FROM ks""",
)
def _(t: Tables):
    counts = [drift_stats.value_counts(df, [], word_count(F.col("text"))) for df in (_train(t), _test(t))]
    return _settle(drift_stats.ks_two_sample(*counts, []), "ks_statistic", "p_value")


@query(
    "G5_data_drift",
    "labelled_texts",
    f"""{TFIDF}, {KS_LENGTHS},
      s AS (SELECT similarity AS c, 1 - similarity AS score, d, p,
        (SELECT avg({WORDS}) FROM labelled_texts WHERE split = 'train') AS ra,
        (SELECT avg({WORDS}) FROM labelled_texts WHERE split = 'test') AS na FROM cosine, ks)
    SELECT {settled("c")} AS cosine_similarity, {settled("score")} AS drift_score, {settled("d")} AS length_ks_statistic,
      {settled("p")} AS length_p_value, {settled("ra")} AS reference_avg_length, {settled("na")} AS new_avg_length,
      score > 0.1 OR p < 0.05 AS is_drift_detected,
      {settled("CASE WHEN score > 0.1 OR p < 0.05 THEN greatest(score, 1 - p) ELSE 1 - score END")} AS confidence FROM s""",
)
def _(t: Tables):
    reference = drift_text.TextReference.fit(_train(t))
    result = reference.data_drift(_test(t), keys=(), column="text").drop("threshold")
    return _settle(
        result, "cosine_similarity", "drift_score", "length_ks_statistic", "length_p_value", "reference_avg_length",
        "new_avg_length", "confidence",
    )


CONCEPT = f"""c AS (SELECT deployment_id, count(*) AS predictions, avg(confidence_score) AS mean,
    stddev_pop(confidence_score) AS std, count(*) FILTER (WHERE confidence_score < 0.6) / CAST(count(*) AS DOUBLE) AS low
    FROM prediction_logs WHERE {RECENT_DAY} GROUP BY 1),
  e0 AS (SELECT deployment_id, count(*) / CAST(sum(count(*)) OVER (PARTITION BY deployment_id) AS DOUBLE) AS p
    FROM prediction_logs WHERE {RECENT_DAY} GROUP BY deployment_id, predicted_sentiment),
  e AS (SELECT deployment_id, greatest(0, -sum(p * log2(p))) AS entropy FROM e0 GROUP BY 1),
  concept AS (SELECT c.*, entropy, mean < 0.7 AS f1, std > 0.3 AS f2, low > 0.3 AS f3, entropy < 0.5 OR entropy > 0.95 AS f4,
    (CAST(mean < 0.7 AS INT) + CAST(std > 0.3 AS INT) + CAST(low > 0.3 AS INT)
      + CAST(entropy < 0.5 OR entropy > 0.95 AS INT)) / CAST(4 AS DOUBLE) AS score FROM c JOIN e ON e.deployment_id = c.deployment_id)"""


@query(
    "G6_concept_drift",
    "prediction_logs",
    f"""WITH {CONCEPT} SELECT deployment_id, predictions, {settled("mean")} AS avg_confidence,
      {settled("low")} AS low_confidence_ratio, {settled("entropy")} AS prediction_entropy,
      {settled("std")} AS confidence_std, f1 AS low_avg_confidence, f2 AS high_confidence_variance,
      f3 AS high_low_confidence_ratio, f4 AS unusual_prediction_entropy, score AS drift_score,
      score > 0.1 AS is_drift_detected FROM concept""",
)
def _(t: Tables):
    recent = filters.since(t.logs, "predicted_at", AS_OF, hours=24)
    result = drift_stats.concept_drift(recent)
    return _settle(result, "avg_confidence", "low_confidence_ratio", "prediction_entropy", "confidence_std")


DAILY = """daily AS (SELECT deployment_id, CAST(predicted_at AS DATE) AS day, avg(confidence_score) AS c,
    avg(prediction_time) AS t, CAST(row_number() OVER (PARTITION BY deployment_id ORDER BY CAST(predicted_at AS DATE)) - 1
      AS DOUBLE) AS i FROM prediction_logs {where} GROUP BY deployment_id, CAST(predicted_at AS DATE))"""


@query(
    "W12_day_index",
    "prediction_logs",
    f"""WITH {DAILY.format(where="")} SELECT deployment_id, day AS prediction_date, i AS day_index FROM daily""",
)
def _(t: Tables):
    daily = daily_performance(t.logs, ["deployment_id"])
    return drift_stats.day_index(daily, ["deployment_id"]).select("deployment_id", "prediction_date", "day_index")


def t_tail(r: str, n: str) -> str:
    """Two-sided Student-t tail of a correlation, summed by gamma coefficients (odd and even degrees of freedom)."""
    df = f"({n} - 2)"
    theta = f"atan(abs({r}) * sqrt({df} / (1 - {r} * {r})) / sqrt({df}))"
    odd = (
        f"(2 / pi()) * ({theta} + sin({theta}) * coalesce(list_sum(list_transform(range(CAST(({df} - 1) / 2 AS BIGINT)), "
        f"lambda k: sqrt(pi()) / 2 * gamma(k + 1) / gamma(k + 1.5) * cos({theta}) ** (2 * k + 1))), 0))"
    )
    even = (
        f"sin({theta}) * coalesce(list_sum(list_transform(range(CAST({df} / 2 AS BIGINT)), "
        f"lambda k: gamma(k + 0.5) / (sqrt(pi()) * gamma(k + 1)) * cos({theta}) ** (2 * k))), 0)"
    )
    return f"(1 - CASE WHEN CAST({df} AS BIGINT) % 2 = 1 THEN {odd} ELSE {even} END)"


@query(
    "G7_linear_trend",
    "prediction_logs",
    f"""WITH {DAILY.format(where="")},
      f AS (SELECT deployment_id, count(c) AS points, regr_slope(c, i) AS slope, regr_intercept(c, i) AS intercept,
        corr(c, i) AS r, CAST(count(c) AS DOUBLE) AS n FROM daily GROUP BY 1)
    SELECT deployment_id, points, {settled("slope", 8)} AS slope, {settled("intercept")} AS intercept,
      {settled("r")} AS r_value, {settled(t_tail("r", "n"))} AS p_value FROM f""",
)
def _(t: Tables):
    daily = drift_stats.day_index(daily_performance(t.logs, ["deployment_id"]), ["deployment_id"])
    trend = drift_stats.linear_trend(daily, ["deployment_id"], "day_index", "avg_confidence")
    return _settle(_settle(trend, "intercept", "r_value", "p_value"), "slope", digits=8)


MODEL = f"""{DAILY.format(where=f"WHERE {RECENT_WEEK}")},
  m0 AS (SELECT deployment_id, count(*) AS points, CAST(count(*) AS DOUBLE) AS n, regr_slope(c, i) AS cs, corr(c, i) AS cr,
    regr_slope(t, i) AS ts, corr(t, i) AS tr, count(*) FILTER (WHERE coalesce(t, 0) = 0) = 0 AS timed FROM daily GROUP BY 1),
  m1 AS (SELECT *, {t_tail("cr", "n")} AS cp, {t_tail("tr", "n")} AS tp FROM m0 WHERE n >= 3),
  m2 AS (SELECT *, cs < -0.05 AND cp < 0.05 AS declining, timed AND ts > 50 AND tp < 0.05 AS degrading FROM m1),
  model AS (SELECT *, declining OR degrading AS drift, CASE WHEN declining THEN abs(cs) WHEN timed THEN abs(ts) / 1000
    ELSE 0 END AS score, 1 - least(cp, CASE WHEN timed THEN tp ELSE 1 END) AS confidence FROM m2)"""


@query(
    "G8_model_drift",
    "prediction_logs",
    f"""WITH {MODEL} SELECT deployment_id, points AS data_points, {settled("cs", 8)} AS confidence_slope,
      {settled("cr")} AS confidence_r, {settled("cp")} AS confidence_p,
      {settled("CASE WHEN timed THEN ts END")} AS time_slope, {settled("CASE WHEN timed THEN tr END")} AS time_r,
      {settled("CASE WHEN timed THEN tp END")} AS time_p, declining AS confidence_declining,
      degrading AS performance_degrading, drift AS is_drift_detected, {settled("score", 8)} AS drift_score,
      {settled("confidence")} AS confidence, CAST(NULL AS VARCHAR) AS error FROM model""",
)
def _(t: Tables):
    result = drift_stats.model_drift(t.logs, AS_OF)
    result = _settle(result, "confidence_r", "confidence_p", "time_slope", "time_r", "time_p", "confidence")
    return _settle(result, "confidence_slope", "drift_score", digits=8)


def _monitored(t: Tables):
    chosen = reference_texts(t.labelled_texts.select("doc_id", "split", "text"))
    return run_monitor(drift_text.TextReference.fit(chosen), t.logs, AS_OF, t.with_texts)


MONITOR = f"""WITH ref AS (SELECT doc_id, text FROM labelled_texts WHERE split = 'validation'),
  recent AS (SELECT id, deployment_id, input_text AS text FROM text_logs WHERE {RECENT_DAY}),
  sides AS (SELECT 'ref' AS k, doc_id AS id, text FROM ref UNION ALL SELECT deployment_id, id, text FROM recent),
  w AS (SELECT k, id, {CLEAN_WORDS} AS words FROM sides),
  g AS (SELECT k, id, unnest({grams("words")}) AS term FROM w),
  tf AS (SELECT k, id, term, count(*) AS n FROM g GROUP BY 1, 2, 3),
  voc AS (SELECT term, ln((1 + CAST((SELECT count(*) FROM ref) AS DOUBLE)) / (1 + count(*))) + 1 AS idf
    FROM tf WHERE k = 'ref' GROUP BY 1 ORDER BY sum(n) DESC, term LIMIT 1000),
  wt AS (SELECT k, id, tf.term, n * idf AS x FROM tf JOIN voc ON voc.term = tf.term),
  nm AS (SELECT k, id, sqrt(sum(x * x)) AS norm FROM wt GROUP BY 1, 2),
  size AS (SELECT k, count(*) AS n FROM w GROUP BY 1),
  mean AS (SELECT wt.k, term, sum(x / norm) / max(size.n) AS a FROM wt JOIN nm ON nm.k = wt.k AND nm.id = wt.id
    JOIN size ON size.k = wt.k GROUP BY 1, 2),
  len AS (SELECT k, sqrt(sum(a * a)) AS l FROM mean GROUP BY 1),
  cosine AS (SELECT b.k, sum(a.a * b.a) / (max(la.l) * max(lb.l)) AS c FROM mean a JOIN mean b ON b.term = a.term
    AND a.k = 'ref' AND b.k <> 'ref' JOIN len la ON la.k = 'ref' JOIN len lb ON lb.k = b.k GROUP BY 1),
  words AS (SELECT k, {WORDS} AS value, count(*) AS n FROM sides GROUP BY 1, 2),
  vals AS (SELECT DISTINCT value FROM words),
  recent_keys AS (SELECT DISTINCT deployment_id AS k FROM recent),
  {ks_sql('''SELECT r.k, vals.value, coalesce(max(x.n), 0) AS a, coalesce(max(y.n), 0) AS b FROM recent_keys r CROSS JOIN vals
    LEFT JOIN words x ON x.k = 'ref' AND x.value = vals.value LEFT JOIN words y ON y.k = r.k AND y.value = vals.value
    GROUP BY 1, 2''')},
  {CONCEPT}, {MODEL},
  busy AS (SELECT deployment_id FROM recent GROUP BY 1 HAVING count(*) >= 10),
  results AS (SELECT ks.k AS deployment_id, 'data' AS drift_type, 1 - c > 0.1 OR p < 0.05 AS is_drift_detected,
      1 - c AS drift_score, CASE WHEN 1 - c > 0.1 OR p < 0.05 THEN greatest(1 - c, 1 - p) ELSE c END AS confidence
    FROM ks JOIN cosine ON cosine.k = ks.k
    UNION ALL SELECT deployment_id, 'concept', score > 0.1, score, score FROM concept
    UNION ALL SELECT deployment_id, 'model', drift, score, confidence FROM model)"""


@query(
    "G9_drift_monitor",
    "prediction_logs text_logs labelled_texts",
    f"""{MONITOR} SELECT deployment_id, drift_type, is_drift_detected, {settled("drift_score")} AS drift_score,
      {settled("confidence")} AS confidence FROM results WHERE deployment_id IN (SELECT deployment_id FROM busy)""",
)
def _(t: Tables):
    return _settle(_monitored(t).drop("details", "error"), "drift_score", "confidence")


@query(
    "G10_drift_alerts",
    "prediction_logs text_logs labelled_texts",
    f"""{MONITOR} SELECT CASE drift_type WHEN 'data' THEN 'DATA_DRIFT' WHEN 'concept' THEN 'CONCEPT_DRIFT' ELSE 'MODEL_DRIFT'
        END AS alert_type, CASE WHEN drift_score > 0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, deployment_id,
      CASE drift_type WHEN 'data' THEN 'Data Drift Detected' WHEN 'concept' THEN 'Concept Drift Detected'
        ELSE 'Model Drift Detected' END AS title,
      printf('Drift detected with score %.3f', drift_score) AS description, drift_type || '_drift_score' AS metric_name,
      {settled("drift_score")} AS metric_value, CAST(0.1 AS DOUBLE) AS threshold_value
    FROM results WHERE is_drift_detected AND deployment_id IN (SELECT deployment_id FROM busy)""",
)
def _(t: Tables):
    return _settle(drift_alerts(_monitored(t)), "metric_value")


MIDDLE = "2024-01-16 00:00:00"


def _halves(t: Tables):
    before = F.col("predicted_at") < filters.moment(MIDDLE)
    return t.logs.filter(before), t.logs.filter(~before)


def _category_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", {column} AS value,
      count(*) FILTER (WHERE predicted_at < TIMESTAMP '{MIDDLE}') AS n_ref,
      count(*) FILTER (WHERE predicted_at >= TIMESTAMP '{MIDDLE}') AS n_cur FROM prediction_logs GROUP BY {column}"""


CATEGORIES = " UNION ALL ".join(_category_sql(c) for c in ("endpoint", "predicted_sentiment", "model_version"))


@query(
    "J6_category_counts",
    "prediction_logs",
    " UNION ALL ".join([CATEGORIES, _category_sql("is_correct").replace("is_correct AS value", "CAST(is_correct AS VARCHAR) AS value")]),
)
def _(t: Tables):
    columns = ["endpoint", "predicted_sentiment", "model_version", "is_correct"]
    return drift_columns.category_counts(*_halves(t), columns)


CATEGORICAL = f"""cat AS ({CATEGORIES}),
  s AS (SELECT *, n_ref / CAST(sum(n_ref) OVER k AS DOUBLE) AS p, n_cur / CAST(sum(n_cur) OVER k AS DOUBLE) AS q,
    CAST(sum(n_ref) OVER k AS DOUBLE) AS nr, CAST(sum(n_cur) OVER k AS DOUBLE) AS nc FROM cat
    WINDOW k AS (PARTITION BY "column")),
  js AS (SELECT "column", sqrt(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS score,
    sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))) AS psi,
    sum((n_ref - (n_ref + n_cur) * nr / (nr + nc)) ** 2 / ((n_ref + n_cur) * nr / (nr + nc))
      + (n_cur - (n_ref + n_cur) * nc / (nr + nc)) ** 2 / ((n_ref + n_cur) * nc / (nr + nc))) AS chi, count(*) AS categories
    FROM s GROUP BY 1)"""


@query(
    "G11_categorical_drift",
    "prediction_logs",
    f"""WITH {CATEGORICAL} SELECT "column", 'jensen_shannon' AS stattest, {settled("score")} AS score, score >= 0.1 AS drift_detected,
      {settled("psi")} AS stability_index, {settled("chi", 4)} AS chi_square, categories FROM js""",
)
def _(t: Tables):
    found = drift_columns.categorical_drift(*_halves(t), ["endpoint", "predicted_sentiment", "model_version"])
    return _settle(_settle(found, "score", "stability_index"), "chi_square", digits=4)


NUMERIC = ks_sql(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS k, CAST({c} AS DOUBLE) AS value, count(*) FILTER (WHERE predicted_at < TIMESTAMP '{MIDDLE}') AS a,
        count(*) FILTER (WHERE predicted_at >= TIMESTAMP '{MIDDLE}') AS b FROM prediction_logs WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in ("confidence_score", "prediction_time", "predicted_label")
    )
)


def _columns(t: Tables):
    return drift_columns.column_drift(
        *_halves(t),
        numeric=["confidence_score", "prediction_time", "predicted_label"],
        categorical=["endpoint", "predicted_sentiment", "model_version"],
    )


@query(
    "G11_numeric_drift",
    "prediction_logs",
    f"""WITH {NUMERIC} SELECT k AS "column", 'kolmogorov_smirnov' AS stattest, {settled("p")} AS score,
      p < 0.05 AS drift_detected, {settled("d")} AS ks_statistic FROM ks""",
)
def _(t: Tables):
    found = drift_columns.numeric_drift(*_halves(t), ["confidence_score", "prediction_time", "predicted_label"])
    return _settle(found, "score", "ks_statistic")


ALL_COLUMNS = f"""WITH {NUMERIC}, {CATEGORICAL}, allc AS (SELECT k AS "column", 'kolmogorov_smirnov' AS stattest, p AS score,
    p < 0.05 AS drift_detected FROM ks UNION ALL SELECT "column", 'jensen_shannon', score, score >= 0.1 FROM js)"""


@query(
    "G11_column_drift",
    "prediction_logs",
    f"""{ALL_COLUMNS} SELECT "column", stattest, {settled("score")} AS score, drift_detected FROM allc""",
)
def _(t: Tables):
    return _settle(_columns(t), "score")


# the lower tail of the chi-square distribution as a power series
CHI_P = """CASE WHEN chi <= 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(range(0, 400 + CAST(ceil(2 * chi) AS INT)),
  lambda j: exp(-chi / 2 + ((categories - 1) / 2.0 + j) * ln(chi / 2) - lgamma((categories - 1) / 2.0 + j + 1))))) END"""
LABELS = f"""cat AS ({_category_sql('endpoint')} UNION ALL {_category_sql('predicted_sentiment')} UNION ALL {_category_sql('model_version')}
  UNION ALL {_category_sql('predicted_label').replace('predicted_label AS value', 'CAST(CAST(predicted_label AS DOUBLE) AS VARCHAR) AS value')}),"""
LISTED = LABELS + CATEGORICAL[CATEGORICAL.index("s AS (") :]
AREAS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value, count(*) FILTER (WHERE predicted_at < TIMESTAMP '{MIDDLE}') AS a,
    count(*) FILTER (WHERE predicted_at >= TIMESTAMP '{MIDDLE}') AS b FROM prediction_logs WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in ("confidence_score", "prediction_time")
)


@query(
    "G11_distances_by_kind",
    "prediction_logs",
    f"""WITH v AS ({AREAS}), {LISTED},
    w AS (SELECT *, sum(a) OVER k - a AS ca, sum(b) OVER k - b AS cb, sum(a) OVER (PARTITION BY "column") AS ta,
      sum(b) OVER (PARTITION BY "column") AS tb, value - lag(value) OVER k AS gap FROM v
      WINDOW k AS (PARTITION BY "column" ORDER BY value)),
    spread AS (SELECT 'confidence_score' AS "column", stddev_pop(confidence_score) AS sd FROM prediction_logs WHERE predicted_at < TIMESTAMP '{MIDDLE}'
      UNION ALL SELECT 'prediction_time', stddev_pop(prediction_time) FROM prediction_logs WHERE predicted_at < TIMESTAMP '{MIDDLE}'),
    far AS (SELECT "column", sum(abs(ca / CAST(ta AS DOUBLE) - cb / CAST(tb AS DOUBLE)) * gap) / greatest(any_value(sd), 0.001) AS score
      FROM w JOIN spread USING ("column") GROUP BY 1)
    SELECT "column", 'wasserstein' AS stattest, {settled("score")} AS score, score >= 0.1 AS drift_detected FROM far
    UNION ALL SELECT "column", 'jensen_shannon', {settled("score")}, score >= 0.1 FROM js""",
)
def _(t: Tables):
    found = drift_columns.drift_by_kind(
        *_halves(t), ["confidence_score", "prediction_time", "predicted_label"], ["endpoint", "predicted_sentiment", "model_version"], small=0
    )
    return _settle(found, "score")


@query(
    "G11_tests_by_kind",
    "prediction_logs",
    f"""WITH {NUMERIC}, {LISTED},
    tested AS (SELECT "column", CASE categories WHEN 2 THEN 'z_test' ELSE 'chi_square' END AS stattest, {CHI_P} AS p FROM js)
    SELECT k AS "column", 'kolmogorov_smirnov' AS stattest, {settled("p")} AS score, p < 0.05 AS drift_detected FROM ks WHERE k <> 'predicted_label'
    UNION ALL SELECT "column", stattest, {settled("p")}, p < 0.05 FROM tested""",
)
def _(t: Tables):
    found = drift_columns.drift_by_kind(
        *_halves(t), ["confidence_score", "prediction_time", "predicted_label"], ["endpoint", "predicted_sentiment", "model_version"], small=1_000_000_000
    )
    return _settle(found, "score")


@query(
    "G4_exact_length_ks",
    "labelled_texts",
    f"""WITH RECURSIVE words AS (SELECT split, {WORDS} AS value FROM labelled_texts
      WHERE label IS NOT NULL AND split IN ('validation', 'test')),
    c AS (SELECT value, count(*) FILTER (WHERE split = 'validation') AS a, count(*) FILTER (WHERE split = 'test') AS b FROM words GROUP BY 1),
    t AS (SELECT sum(a) AS n, sum(b) AS m FROM c),
    d AS (SELECT CAST(n AS BIGINT) AS n, CAST(m AS BIGINT) AS m, CAST(max(abs(ca * m - cb * n)) AS BIGINT) AS far FROM
      (SELECT sum(a) OVER (ORDER BY value) AS ca, sum(b) OVER (ORDER BY value) AS cb FROM c), t GROUP BY n, m),
    walk AS (SELECT 0 AS s, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 THEN CAST(1 AS DOUBLE) ELSE 0 END) AS p FROM d
      UNION ALL SELECT s + 1, list_transform(range(0, n + 1), lambda i: CASE WHEN i <= s + 1 AND s + 1 - i <= m AND abs(i * m - (s + 1 - i) * n) < far
        THEN p[i + 1] * (s + 1 - i) / (s + 1) + coalesce(p[i], 0) * i / (s + 1) ELSE CAST(0 AS DOUBLE) END) FROM walk, d WHERE s < n + m)
    SELECT n AS n_ref, m AS n_cur, {settled("far / CAST(n * m AS DOUBLE)")} AS ks_statistic, {settled("1 - p[n + 1]")} AS p_value FROM walk, d WHERE s = n + m""",
)
def _(t: Tables):
    counted = t.labelled_texts.filter("label IS NOT NULL").select("split", word_count(F.col("text")).alias("words"))
    sides = [drift_stats.value_counts(counted.filter(F.col("split") == s), [], F.col("words")) for s in ("validation", "test")]
    found = drift_stats.ks_two_sample(*sides, [], exact_cells=4_000_000)
    return _settle(found.select("n_ref", "n_cur", "ks_statistic", "p_value"), "ks_statistic", "p_value")


@query(
    "G12_drift_summary",
    "prediction_logs",
    f"""{ALL_COLUMNS} SELECT count(*) AS columns, count(*) FILTER (WHERE drift_detected) AS drifted_columns,
      {settled("count(*) FILTER (WHERE drift_detected) / CAST(count(*) AS DOUBLE)")} AS drift_share,
      count(*) FILTER (WHERE drift_detected) / CAST(count(*) AS DOUBLE) >= 0.5 AS dataset_drift,
      coalesce(string_agg("column" || ':' || stattest, ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted
    FROM allc""",
)
def _(t: Tables):
    summary = drift_columns.drift_summary(_columns(t))
    named = F.transform("drifted_features", lambda f: F.concat_ws(":", f["feature"], f["stattest"]))
    return _settle(summary.withColumn("drifted", F.array_join(named, ",")).drop("drifted_features"), "drift_share")


@query(
    "G13_rank_sum_auc",
    "prediction_logs",
    f"""WITH r AS (SELECT endpoint, predicted_at >= TIMESTAMP '{MIDDLE}' AS current, confidence_score AS s FROM prediction_logs WHERE confidence_score IS NOT NULL),
    k AS (SELECT *, rank() OVER (PARTITION BY endpoint ORDER BY s) + (count(*) OVER (PARTITION BY endpoint, s) - 1) / 2.0 AS mid FROM r),
    t AS (SELECT endpoint, count(*) FILTER (WHERE NOT current) AS n_ref, count(*) FILTER (WHERE current) AS n_cur,
      CAST(sum(mid) FILTER (WHERE current) AS DOUBLE) AS ranks FROM k GROUP BY 1)
    SELECT endpoint, n_ref, n_cur, {settled("(ranks - n_cur * (n_cur + 1) / 2.0) / nullif(CAST(n_ref AS DOUBLE) * n_cur, 0)")} AS auc FROM t""",
)
def _(t: Tables):
    sided = t.logs.withColumn("label", (F.col("predicted_at") >= filters.moment(MIDDLE)).cast("int"))
    return _settle(drift_content.area_under_curve(sided, ["endpoint"], value="confidence_score"), "auc")


@query(
    "G13_content_drift",
    "",
    """SELECT 'another language' AS compared, true AS told_apart UNION ALL SELECT 'equal sides', false""",
)
def _(t: Tables):
    english, german = (t.documents.filter(F.col("lang") == lang) for lang in ("en", "de"))
    made = [
        drift_content.content_drift(reference, current, scratch_folder(t.spark, "content")).select(
            F.lit(name).alias("compared"), F.when(F.col("auc").between(0.45, 0.55), False).when(F.col("auc") > 0.9, True).alias("told_apart")
        )
        for name, reference, current in (("another language", english, german), ("equal sides", english, english))
    ]
    return made[0].unionByName(made[1])


DESCRIBED = f"""{REFERENCE_TOKENS}, d0 AS (SELECT doc_id, split, {DESCRIPTORS}, {TOKENS} AS toks FROM labelled_texts),
  kn AS (SELECT doc_id, count(*) FILTER (WHERE token IN (SELECT token FROM reference_tokens)) AS known
    FROM (SELECT doc_id, unnest(toks) AS token FROM d0) GROUP BY 1),
  d AS (SELECT split, text_length, word_count, non_letter_share,
    CASE WHEN len(toks) = 0 THEN 0 ELSE 1 - known / CAST(len(toks) AS DOUBLE) END AS oov_share
    FROM d0 LEFT JOIN kn ON kn.doc_id = d0.doc_id)"""
DESCRIPTOR_COLUMNS = ("text_length", "word_count", "non_letter_share", "oov_share")


@query(
    "G13_descriptor_drift",
    "labelled_texts",
    "WITH " + DESCRIBED + ", " + ks_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS k, CAST({c} AS DOUBLE) AS value, count(*) FILTER (WHERE split = 'train') AS a,
            count(*) FILTER (WHERE split = 'test') AS b FROM d GROUP BY {c}"""
            for c in DESCRIPTOR_COLUMNS
        )
    )
    + f""" SELECT k AS "column", 'kolmogorov_smirnov' AS stattest, {settled("p")} AS score, p < 0.05 AS drift_detected,
      {settled("d")} AS ks_statistic FROM ks""",
)
def _(t: Tables):
    vocabulary = texts.reference_tokens(_train(t))
    described = stored(texts.describe(t.labelled_texts, vocabulary), "descriptors")
    sides = [described.filter(F.col("split") == s) for s in ("train", "test")]
    return _settle(drift_columns.numeric_drift(*sides, list(DESCRIPTOR_COLUMNS)), "score", "ks_statistic")
