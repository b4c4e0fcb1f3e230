"""Checked queries over time: histograms, rates, quantiles, concurrency, repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.functions.sizes import stored
from tallywatch.operators import requests, series, sketches, usage
from tallywatch.plans.registry import query, settled
from tallywatch.sources.canonical import Tables


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


def _values(bounds) -> str:
    return ", ".join([f"('{float(b)}', CAST({b} AS DOUBLE))" for b in bounds] + ["('+Inf', CAST('Infinity' AS DOUBLE))"])


def _histogram_sql(label: str, value: str, bounds) -> str:
    return f"""WITH v AS (SELECT {label}, {value} AS x FROM prediction_logs),
      s AS (SELECT {label}, {settled("coalesce(sum(x), 0)", 3)} AS value_sum, count(x) AS value_count FROM v GROUP BY 1),
      b(le, edge) AS (VALUES {_values(bounds)}),
      h AS (SELECT {label}, le, count(x) FILTER (WHERE x <= edge) AS bucket_count FROM v CROSS JOIN b GROUP BY 1, 2)
    SELECT h.{label}, le, bucket_count, value_sum, value_count FROM h JOIN s ON s.{label} = h.{label}"""


def _histogram(t: Tables, label: str, value, bounds):
    filled = series.histogram(t.logs, [label], value, bounds).withColumn(
        "value_sum", F.coalesce("value_sum", F.lit(0.0))
    )
    return _settle(filled, "value_sum", digits=3)


def _duration():
    return F.col("prediction_time") / 1000


@query(
    "A21_J9_duration_histogram",
    "prediction_logs",
    _histogram_sql("endpoint", "prediction_time / 1000", series.DURATION_BOUNDS),
)
def _(t: Tables):
    return _histogram(t, "endpoint", _duration(), series.DURATION_BOUNDS)


@query(
    "A21_confidence_histogram",
    "prediction_logs",
    _histogram_sql("predicted_sentiment", "confidence_score", series.CONFIDENCE_BOUNDS),
)
def _(t: Tables):
    return _histogram(t, "predicted_sentiment", F.col("confidence_score"), series.CONFIDENCE_BOUNDS)


@query(
    "A21_default_bounds_histogram",
    "prediction_logs",
    _histogram_sql("deployment_id", "prediction_time / 1000", series.DEFAULT_BOUNDS),
)
def _(t: Tables):
    return _histogram(t, "deployment_id", _duration(), series.DEFAULT_BOUNDS)


@query("T1_total", "prediction_logs", "SELECT count(*) AS total FROM prediction_logs")
def _(t: Tables):
    return usage.counter(t.logs, [])


@query(
    "T1_total_by_sentiment",
    "prediction_logs",
    "SELECT predicted_sentiment, count(*) AS total FROM prediction_logs GROUP BY 1",
)
def _(t: Tables):
    return usage.counter(t.logs, ["predicted_sentiment"])


FIVE = "time_bucket(INTERVAL 5 MINUTE, predicted_at, TIMESTAMP '2000-01-01')"


@query(
    "T2_request_rate",
    "prediction_logs",
    f"SELECT {FIVE} AS window_start, count(*) AS events, {settled('count(*) / CAST(300 AS DOUBLE)')} AS rate FROM prediction_logs GROUP BY 1",
)
def _(t: Tables):
    return _settle(series.rates(t.logs, "predicted_at"), "rate")


@query(
    "T2_sliding_rate_per_minute",
    "prediction_logs",
    f"""WITH s AS (SELECT predicted_sentiment, unnest(range(5)) AS back,
        time_bucket(INTERVAL 1 MINUTE, predicted_at, TIMESTAMP '2000-01-01') AS m FROM prediction_logs)
    SELECT predicted_sentiment, m - to_minutes(back) AS window_start, count(*) AS events,
      {settled("count(*) * CAST(60 AS DOUBLE) / 300")} AS rate FROM s GROUP BY 1, 2""",
)
def _(t: Tables):
    sliding = series.rates(t.logs, "predicted_at", ["predicted_sentiment"], slide_seconds=60, per=60.0)
    return _settle(sliding, "rate")


def _bucket_quantile(q: float) -> str:
    return settled(
        f"max(CASE WHEN first_{int(q * 100)} THEN CASE WHEN edge = 'Infinity' THEN 5.0 ELSE low + (edge - low) * "
        f"(n * CAST({q} AS DOUBLE) - under) / nullif(c - under, 0) END END)"
    )


def _first(q: float) -> str:
    rank = f"n * CAST({q} AS DOUBLE)"
    return f"n > 0 AND c >= {rank} AND (under < {rank} OR edge = 0.01) AS first_{int(q * 100)}"


@query(
    "T3_histogram_quantiles",
    "prediction_logs",
    f"""WITH b(le, edge) AS (VALUES {_values(series.DURATION_BOUNDS)}),
      h AS (SELECT {FIVE} AS w, endpoint, edge, count(prediction_time) FILTER (WHERE prediction_time / 1000 <= edge) AS c,
        count(prediction_time) AS n FROM prediction_logs CROSS JOIN b GROUP BY 1, 2, 3),
      l AS (SELECT *, coalesce(lag(edge) OVER k, 0) AS low, coalesce(lag(c) OVER k, 0) AS under FROM h
        WINDOW k AS (PARTITION BY w, endpoint ORDER BY edge)),
      f AS (SELECT *, {_first(0.5)}, {_first(0.95)}, {_first(0.99)} FROM l)
    SELECT w AS window_start, endpoint, {_bucket_quantile(0.5)} AS p50, {_bucket_quantile(0.95)} AS p95,
      {_bucket_quantile(0.99)} AS p99 FROM f GROUP BY 1, 2""",
)
def _(t: Tables):
    return _settle(series.window_quantiles(t.logs, "predicted_at", ["endpoint"], _duration()), "p50", "p95", "p99")


@query(
    "T3_exact_quantiles",
    "prediction_logs",
    f"""SELECT CAST(CAST(predicted_at AS DATE) AS TIMESTAMP) AS window_start, endpoint,
      {settled("quantile_cont(prediction_time, 0.5)", 4)} AS p50, {settled("quantile_cont(prediction_time, 0.95)", 4)} AS p95,
      {settled("quantile_cont(prediction_time, 0.99)", 4)} AS p99
    FROM prediction_logs WHERE prediction_time IS NOT NULL GROUP BY 1, 2""",
)
def _(t: Tables):
    exact = series.exact_window_quantiles(t.logs, "predicted_at", ["endpoint"], F.col("prediction_time"))
    return _settle(exact, "p50", "p95", "p99", digits=4)


@query("T3_approximate_quantiles")
def _(t: Tables):
    return series.approximate_window_quantiles(
        t.logs, "predicted_at", ["endpoint"], F.col("prediction_time"), width="1 day"
    )


@query(
    "T3_approximate_within_bound",
    "prediction_logs",
    """SELECT CAST(date_trunc('day', predicted_at) AS TIMESTAMP) AS window_start, endpoint, true AS within_bound
    FROM prediction_logs GROUP BY 1, 2 HAVING count(prediction_time) > 0""",
)
def _(t: Tables):
    # an approximate quantile lies between the exact quantiles a rank error of 1 / accuracy away, widened to whole rows
    labels, value, width = ["endpoint"], F.col("prediction_time"), "1 day"
    rough = series.approximate_window_quantiles(t.logs, "predicted_at", labels, value, {"p95": 0.95}, width)
    around = series.exact_window_quantiles(t.logs, "predicted_at", labels, value, {"low": 0.90, "high": 1.0}, width)
    joined = rough.join(around, ["window_start", "endpoint"])
    return joined.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "endpoint",
        F.col("p95").between(F.col("low"), F.col("high")).alias("within_bound"),
    )


@query(
    "T3_merged_sketches",
    "prediction_logs",
    """SELECT CAST(date_trunc('day', predicted_at) AS TIMESTAMP) AS window_start, endpoint, CAST(count(prediction_time) AS BIGINT) AS n,
      count(prediction_time) > 0 AS p95_within_bound, true AS clients_within_bound FROM prediction_logs GROUP BY 1, 2""",
)
def _(t: Tables):
    # panes of five minutes are stored and merged to days; a merged quantile lies between the exact ones of nearby ranks
    labels, value, width = ["endpoint"], F.col("prediction_time"), "1 day"
    panes = stored(sketches.sketch_panes(t.logs, "predicted_at", labels, value, F.col("client_id")), "panes")
    merged = sketches.from_panes(panes, labels, width, quantiles={"p95": 0.95})
    low, high = 0.95 - sketches.RANK_ERROR - 0.03, min(1.0, 0.95 + sketches.RANK_ERROR + 0.03)  # widened to whole rows
    around = series.exact_window_quantiles(t.logs, "predicted_at", labels, value, {"low": low, "high": high}, width)
    clients = t.logs.groupBy(F.window("predicted_at", width)["start"].alias("window_start"), "endpoint").agg(F.count_distinct("client_id").alias("exact"))
    joined = merged.join(around, ["window_start", "endpoint"], "left").join(clients, ["window_start", "endpoint"])
    near = F.abs(F.col("clients") - F.col("exact")) <= F.greatest(F.lit(1.0), sketches.COUNT_ERROR * F.col("exact"))
    return joined.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "endpoint", "n",
        F.coalesce(F.col("p95").between(F.col("low"), F.col("high")), F.lit(False)).alias("p95_within_bound"), near.alias("clients_within_bound"),
    )


@query(
    "T4_mean_confidence",
    "prediction_logs",
    f"""SELECT {FIVE} AS window_start, predicted_sentiment, {settled("avg(confidence_score)")} AS mean,
      count(confidence_score) AS n FROM prediction_logs GROUP BY 1, 2""",
)
def _(t: Tables):
    return _settle(series.window_means(t.logs, "predicted_at", "confidence_score", ["predicted_sentiment"]), "mean")


@query(
    "T5_error_rates",
    "prediction_logs",
    f"""SELECT {FIVE} AS window_start, {settled("count(*) FILTER (WHERE is_error) * CAST(60 AS DOUBLE) / 300")}
      AS errors_per_minute, {settled("count(*) FILTER (WHERE is_error) / CAST(count(*) AS DOUBLE)")} AS error_ratio
    FROM prediction_logs GROUP BY 1""",
)
def _(t: Tables):
    return _settle(series.error_rates(t.logs, "predicted_at"), "errors_per_minute", "error_ratio")


@query(
    "T6_peak_concurrency",
    "",
    """WITH s AS (SELECT epoch_us(ts) AS moment, 1 AS d FROM events
        UNION ALL SELECT epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT), -1 FROM events),
      n AS (SELECT moment, sum(d) AS d FROM s GROUP BY 1),
      r AS (SELECT moment, sum(d) OVER (ORDER BY moment) AS active FROM n)
    SELECT make_timestamp((moment // 300000000) * 300000000) AS window_start, CAST(max(active) AS BIGINT) AS peak_active
    FROM r GROUP BY 1""",
)
def _(t: Tables):
    # the test data's values serve as durations in seconds, so that requests overlap
    spent = F.round(F.col("value") * 1_000_000).cast("bigint")
    return requests.peak_concurrency(t.raw("events"), "ts", spent)


@query(
    "T6_peak_concurrency_per_type",
    "",
    """WITH s AS (SELECT event_type, epoch_us(ts) AS moment, 1 AS d FROM events
        UNION ALL SELECT event_type, epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT), -1 FROM events),
      n AS (SELECT event_type, moment, sum(d) AS d FROM s GROUP BY 1, 2),
      r AS (SELECT event_type, moment, sum(d) OVER (PARTITION BY event_type ORDER BY moment) AS active FROM n)
    SELECT event_type, make_timestamp((moment // 300000000) * 300000000) AS window_start,
      CAST(max(active) AS BIGINT) AS peak_active FROM r GROUP BY 1, 2""",
)
def _(t: Tables):
    spent = F.round(F.col("value") * 1_000_000).cast("bigint")
    return requests.peak_concurrency(t.raw("events"), "ts", spent, ["event_type"])


@query(
    "W18_would_be_cache_hits",
    "prediction_logs text_logs",
    f"""WITH l AS (SELECT input_hash, id, predicted_at, epoch_us(predicted_at) AS moment,
        lag(epoch_us(predicted_at)) OVER (PARTITION BY input_hash ORDER BY predicted_at, id) AS before FROM text_logs)
    SELECT input_hash, id, predicted_at, {settled("(moment - before) / CAST(1000000 AS DOUBLE)")} AS seconds_since,
      coalesce(moment - before <= 43200000000, false) AS would_hit FROM l""",
)
def _(t: Tables):
    # half a day instead of five minutes, so that the sparse test data has hits
    repeats = requests.repeats_within(t.with_texts(t.logs), seconds=43_200)
    return _settle(repeats, "seconds_since")


@query(
    "W19_clients_over_rate",
    "prediction_logs",
    """WITH c AS (SELECT client_id, predicted_at, count(*) OVER (PARTITION BY client_id ORDER BY predicted_at
        RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n FROM prediction_logs)
    SELECT DISTINCT client_id, predicted_at, n FROM c WHERE n > 1""",
)
def _(t: Tables):
    # more than one request an hour instead of a hundred a minute, for the sparse test data
    return requests.over_rate(t.logs, ["client_id"], "predicted_at", seconds=3600, limit=1)
