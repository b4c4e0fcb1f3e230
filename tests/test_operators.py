from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import (
    alerts,
    batches,
    datasets,
    drift_columns,
    drift_stats,
    experiments,
    filters,
    folds,
    health,
    quality,
    requests,
    scoring,
    series,
    usage,
    validation,
)
from tallywatch.operators.drift_text import TextReference

NOW = datetime(2024, 5, 10, 12)
LOG = "id int, deployment_id string, predicted_sentiment string, confidence_score double, prediction_time double, predicted_at timestamp_ntz, is_error boolean"


def logs(spark, *rows):
    """Rows of (deployment, sentiment, confidence, time, hours before NOW)."""
    data = [(i, d, s, c, t, NOW - timedelta(hours=h), False) for i, (d, s, c, t, h) in enumerate(rows)]
    return spark.createDataFrame(data, LOG)


def test_statistics_leave_out_null_and_zero(spark):
    frame = logs(spark, ("d", "POSITIVE", 0.0, None, 1), ("d", "POSITIVE", 0.5, 0.0, 24), ("d", "NEGATIVE", None, 30.0, 2), ("d", "NEGATIVE", 0.9, 10.0, 25))
    row = usage.prediction_statistics(frame, NOW).first()
    assert (row.total_predictions, row.avg_confidence, row.min_confidence, row.max_confidence) == (3, 0.5, 0.5, 0.5)
    assert row.avg_prediction_time == 30.0 and row.predictions_per_hour == 3 / 24


def test_statistics_are_zero_when_nothing_is_truthy(spark):
    row = usage.prediction_statistics(logs(spark, ("d", None, None, 0.0, 1)), NOW).first()
    assert (row.avg_confidence, row.min_confidence, row.avg_prediction_time) == (0.0, 0.0, 0.0)


def test_deployment_metrics_divide_by_all_rows(spark):
    deployments = spark.createDataFrame([("d", "one", "ACTIVE"), ("e", "two", "ACTIVE")], "id string, deployment_name string, status string")
    frame = logs(spark, ("d", "POSITIVE", 0.5, None, 1), ("d", "POSITIVE", None, 30.0, 2), ("gone", "POSITIVE", 1.0, 1.0, 1))
    rows = {r.deployment_id: r for r in usage.deployment_metrics(deployments, frame, NOW).collect()}
    assert set(rows) == {"d", "e"} and rows["e"].total_predictions is None
    assert (rows["d"].avg_prediction_time_ms, rows["d"].avg_confidence_score) == (15.0, 0.25)


def test_experiment_seed_data(spark):
    at = datetime(2024, 1, 3)
    runs = spark.createDataFrame(
        [
            ("exp_001", "sentiment_analysis", "COMPLETED", 0.856, 0.851, 3600.5, at - timedelta(days=2)),
            ("exp_002", "sentiment_analysis", "COMPLETED", 0.872, 0.869, 7200.3, at - timedelta(days=1)),
            ("exp_003", "sentiment_analysis", "COMPLETED", 0.863, 0.860, 5400.8, at - timedelta(hours=6)),
            ("exp_004", "sentiment_analysis", "RUNNING", None, None, None, None),
        ],
        "id string, experiment_name string, status string, accuracy double, f1_score double, training_duration double, created_at timestamp_ntz",
    )
    assert [r.id for r in experiments.best_runs(runs).collect()] == ["exp_002", "exp_003", "exp_001"]
    row = experiments.experiment_summary(runs).first()
    assert row.run_count == 4 and row.best_accuracy == 0.872
    assert row.avg_accuracy == pytest.approx(0.863667, abs=1e-6) and row.avg_training_duration == pytest.approx(5400.533, abs=1e-3)
    with pytest.raises(ValueError):
        experiments.best_runs(runs, "no_such_metric")


def test_best_checkpoint_of_the_training_log(spark):
    log = spark.createDataFrame(
        [("r", 1.0, 0.3922, 0.826), ("r", 2.0, 0.2929, 0.880), ("r", 2.99, 0.2952, 0.883)], "run_id string, epoch double, eval_loss double, eval_f1 double"
    )
    assert experiments.best_checkpoint(log, ["run_id"]).first().epoch == 2.99
    assert experiments.best_checkpoint(log, ["run_id"], "eval_loss", highest=False).first().epoch == 2.0


def fold_one_by_one(status, events):
    """The alert rules applied to one action after another."""
    state = {"status": status, "acknowledged_at": None, "resolved_at": None, "resolved_by": None, "resolution_notes": None}
    for _, action, actor, notes, at in sorted(events):
        if action == "acknowledge" and state["status"] == "ACTIVE":
            state |= {"status": "ACKNOWLEDGED", "acknowledged_at": at, "resolution_notes": f"Acknowledged by: {actor}"}
        elif action == "resolve":
            state |= {"status": "RESOLVED", "resolved_at": at, "resolved_by": actor}
            if notes:
                state["resolution_notes"] = notes
    return state


def test_alert_lifecycle_equals_one_action_after_another(spark):
    rng = random.Random(4)
    started = [(i, rng.choice(["ACTIVE", "ACTIVE", "ACKNOWLEDGED", "RESOLVED"])) for i in range(120)]
    events = []
    for seq in range(900):
        alert = 0 if rng.random() < 0.4 else rng.randrange(150)
        action = rng.choice(["acknowledge", "acknowledge", "resolve"])
        events.append((alert, seq, action, f"u{rng.randrange(5)}", rng.choice([None, "", f"note {seq}"]), NOW + timedelta(seconds=seq)))
    rng.shuffle(events)
    got = folds.alert_lifecycle(
        spark.createDataFrame(started, "id int, status string"),
        spark.createDataFrame(events, "alert_id int, seq int, action string, actor string, notes string, happened_at timestamp_ntz"),
    )
    expected = {a: fold_one_by_one(s, [e[1:] for e in events if e[0] == a]) for a, s in started}
    assert {r.alert_id: {k: r[k] for k in folds.ALERT_STATE} for r in got.collect()} == expected


def test_run_updates_set_null_and_ignore_unknown_fields(spark):
    runs = spark.createDataFrame([(1, "RUNNING", 0.5, 0.4), (2, "RUNNING", 0.7, 0.6)], "id int, status string, accuracy double, f1_score double")
    changes = spark.createDataFrame(
        [(1, 1, "accuracy", "0.9", NOW), (1, 2, "accuracy", None, NOW), (1, 3, "status", "FAILED", NOW), (1, 4, "colour", "red", NOW)],
        "run_id int, seq int, field string, value string, changed_at timestamp_ntz",
    )
    rows = {r.id: r for r in folds.apply_run_updates(runs, changes).collect()}
    assert (rows[1].status, rows[1].accuracy, rows[1].f1_score) == ("FAILED", None, 0.4)
    assert (rows[2].status, rows[2].accuracy, rows[2].updated_at) == ("RUNNING", 0.7, None)


def test_deployment_updates_keep_what_was_not_given(spark):
    changes = spark.createDataFrame(
        [("d", 1, "ACTIVE", "HEALTHY", 5, None, None, NOW), ("d", 2, None, None, None, 12.5, None, NOW + timedelta(1)), ("d", 3, "FAILED", "", None, None, 0.0, NOW + timedelta(2))],
        "deployment_id string, seq int, status string, health_status string, request_count int, avg_response_time double, error_rate double, changed_at timestamp_ntz",
    )
    row = folds.fold_deployment_updates(changes).first()
    assert (row.status, row.health_status, row.request_count, row.avg_response_time, row.error_rate) == ("FAILED", "HEALTHY", 5, 12.5, 0.0)
    assert row.last_health_check == row.updated_at == NOW + timedelta(2)


def test_alert_summary_marginals_add_up(spark):
    rows = [("DATA_DRIFT", "HIGH", "RESOLVED", NOW - timedelta(days=1), NOW - timedelta(days=1) + timedelta(hours=3)),
            ("ERROR", "LOW", "RESOLVED", NOW - timedelta(days=2), None), ("ERROR", "HIGH", "ACTIVE", NOW, None), ("ERROR", "HIGH", "ACTIVE", NOW - timedelta(days=8), None)]
    frame = spark.createDataFrame(rows, "alert_type string, severity string, status string, triggered_at timestamp_ntz, resolved_at timestamp_ntz")
    got = alerts.alert_summary(frame, NOW).collect()
    total = next(r for r in got if r.dimension == "total")
    assert total.n == 3 and total.avg_resolution_time_hours == 3.0 and total.alerts_per_day == 3 / 7
    for dimension in ("status", "severity", "alert_type"):
        assert sum(r.n for r in got if r.dimension == dimension) == 3


def test_drift_alert_texts(spark):
    results = spark.createDataFrame(
        [("d", "concept", True, 0.25), ("d", "model", True, 0.31), ("d", "data", False, 0.05)], "deployment_id string, drift_type string, is_drift_detected boolean, drift_score double"
    )
    got = {r.alert_type: r for r in alerts.drift_alerts(results).collect()}
    assert set(got) == {"CONCEPT_DRIFT", "MODEL_DRIFT"}
    assert got["CONCEPT_DRIFT"].severity == "MEDIUM" and got["MODEL_DRIFT"].severity == "HIGH"
    assert got["MODEL_DRIFT"].title == "Model Drift Detected" and got["MODEL_DRIFT"].description == "Drift detected with score 0.310"
    assert got["CONCEPT_DRIFT"].metric_name == "concept_drift_score" and got["CONCEPT_DRIFT"].threshold_value == 0.1


def test_health_takes_the_worst_component(spark):
    frame = spark.createDataFrame([("a", "healthy"), ("a", "degraded"), ("b", "unhealthy"), ("b", "critical"), ("c", "healthy")], "k string, status string")
    got = {r.k: r.overall_status for r in health.overall_health(frame, ["k"]).collect()}
    assert got == {"a": "degraded", "b": "critical", "c": "healthy"}


def test_quality_of_missing_columns_and_odd_labels(spark):
    frame = spark.createDataFrame([("t", [1, 2], [1, 1], 0), ("t", [1], [1, 1], None), ("v", [1], [1], 1)], "split string, input_ids array<int>, attention_mask array<int>, label int")
    got = {(r.split, r.check): (r.score, r.passed) for r in quality.quality_checks(frame).collect()}
    assert got[("t", "consistency")] == (0.8, False) and got[("t", "validity")] == (0.7, False)
    assert got[("t", "completeness")] == (pytest.approx(1 - 1 / 6), False) and got[("v", "completeness")] == (1.0, True)
    bare = quality.quality_checks(frame.select("split")).filter("check = 'completeness'").first()
    assert (bare.score, bare.passed) == (0.0, False)
    report = {r.split: r.quality_score for r in quality.quality_report(frame).collect()}
    assert report == {"t": 0.0, "v": 1.0, None: 0.5}


@pytest.mark.parametrize("size", [0.2, 0.33, 1.0])
def test_stratified_split_is_exact_per_label(spark, size):
    rng = random.Random(5)
    labels = [1 if rng.random() < 0.8 else rng.choice([0, None]) for _ in range(1500)]
    frame = spark.createDataFrame([(i, label) for i, label in enumerate(labels)], "doc_id int, label int")
    got = datasets.stratified_split(frame, "doc_id", test_size=size).collect()
    assert len(got) == 1500
    for label in (0, 1, None):
        taken = sum(r.label == label and r.split == "validation" for r in got)
        assert taken == math.ceil(size * labels.count(label))


def test_validation_is_made_only_when_absent(spark):
    frame = spark.createDataFrame([(i, i % 2, "train") for i in range(100)] + [(200, 1, "test")], "doc_id int, label int, split string")
    made = datasets.with_validation(frame, "doc_id")
    assert {(r.split, r["count"]) for r in made.groupBy("split").count().collect()} == {("train", 80), ("validation", 20), ("test", 1)}
    assert datasets.with_validation(made, "doc_id") is made and datasets.with_validation(frame, "doc_id", validation_size=0) is frame


def test_quality_degradation_of_the_two_newest_rows(spark):
    rows = [("d", "train", NOW, 0.7, 0.0, 0.9, None), ("d", "test", NOW - timedelta(days=1), 0.9, 0.9, 1.0, 1.0), ("d", "train", NOW - timedelta(days=2), 0.1, 0.1, 0.1, 0.1), ("e", "train", NOW, 0.1, 0.1, 0.1, 0.1)]
    frame = spark.createDataFrame(rows, "dataset_name string, split_name string, computed_at timestamp_ntz, quality_score double, completeness_score double, consistency_score double, validity_score double")
    got = datasets.quality_degradation(frame).collect()
    assert [(r.dataset_name, r.metric) for r in got] == [("d", "quality_score")]
    assert got[0].degradation == pytest.approx(0.2)
    assert datasets.quality_degradation(frame, mode="split").count() == 0


def test_text_and_batch_validation(spark):
    frame = spark.createDataFrame([(1, " ok "), (2, ""), (3, " \n"), (4, "x" * 5001), (5, None), (6, " " * 5000 + "x")], "id int, text string")
    got = {r.id: (r.reason, r.clean_text) for r in validation.validate_texts(frame).collect()}
    assert got == {1: (None, "ok"), 2: ("too_short", None), 3: ("blank", None), 4: ("too_long", None), 5: ("missing", None), 6: ("too_long", None)}
    sets = spark.createDataFrame([(1, ["a", " b "]), (2, []), (3, ["a"] * 101), (4, ["a", " "])], "id int, texts array<string>")
    reasons = {r.id: (r.reason, r.clean_texts) for r in validation.validate_batches(sets).collect()}
    assert reasons == {1: (None, ["a", "b"]), 2: ("too_few", None), 3: ("too_many", None), 4: ("blank_item", None)}


def test_sliding_counts_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.6 else "b", NOW + timedelta(seconds=rng.randrange(2000))) for _ in range(500)]
    frame = spark.createDataFrame(rows, "client string, at timestamp_ntz")
    got = {(r.client, r["at"]): r.n for r in requests.sliding_counts(frame, ["client"], "at", 60, bucket_seconds=100).collect()}
    for (client, at), n in got.items():
        assert n == sum(c == client and at - timedelta(seconds=60) <= x <= at for c, x in rows)
    assert set(got) == set(rows)


def test_concurrency_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [(NOW + timedelta(seconds=rng.randrange(3000)), rng.randrange(1, 400)) for _ in range(200)]
    frame = spark.createDataFrame(rows, "at timestamp_ntz, seconds int")
    got = requests.concurrency(frame, "at", F.col("seconds").cast("bigint") * 1_000_000, bucket_seconds=120)
    for r in got.collect():
        moment = datetime(1970, 1, 1) + timedelta(microseconds=r["at"])
        assert r.active == sum(start <= moment < start + timedelta(seconds=s) for start, s in rows)


def test_histogram_and_quantiles(spark):
    frame = spark.createDataFrame([("a", v) for v in (0.01, 0.02, 0.3, 9.0, None)], "endpoint string, v double")
    got = {r.le: r.bucket_count for r in series.histogram(frame, ["endpoint"], F.col("v"), series.DURATION_BOUNDS).collect()}
    assert got["0.01"] == 1 and got["0.05"] == 2 and got["5.0"] == 3 and got["+Inf"] == 4
    timed = frame.withColumn("ts", F.lit(NOW).cast("timestamp_ntz"))
    row = series.window_quantiles(timed, "ts", ["endpoint"], F.col("v"), quantiles={"p25": 0.25, "p50": 0.5, "p99": 0.99}).first()
    assert row.p25 == pytest.approx(0.01) and row.p50 == pytest.approx(0.05) and row.p99 == 5.0


def test_ks_distance_equals_brute_force_and_is_zero_for_equal_samples(spark):
    rng = random.Random(8)
    ref = [rng.randrange(30) for _ in range(200)]
    cur = {"same": ref, "moved": [rng.randrange(5, 60) for _ in range(90)], "one": [7]}
    counts = drift_stats.value_counts(spark.createDataFrame([(v,) for v in ref], "v int"), [], F.col("v"))
    current = spark.createDataFrame([(k, v) for k, vs in cur.items() for v in vs], "k string, v int")
    got = {r.k: r for r in drift_stats.ks_two_sample(counts, drift_stats.value_counts(current, ["k"], F.col("v")), ["k"]).collect()}
    for k, values in cur.items():
        expected = max(abs(sum(a <= x for a in ref) / len(ref) - sum(b <= x for b in values) / len(values)) for x in range(-1, 70))
        assert got[k].ks_statistic == pytest.approx(expected) and got[k].n_cur == len(values)
    assert got["same"].p_value == 1.0 and got["moved"].p_value < 0.05


def test_concept_drift_flags(spark):
    frame = logs(spark, *[("sure", "POSITIVE", 0.9, 1.0, 1)] * 10, *[("even", s, c, 1.0, 1) for s, c in [("POSITIVE", 0.95), ("NEGATIVE", 0.2)] * 5])
    got = {r.deployment_id: r for r in drift_stats.concept_drift(frame).collect()}
    assert got["sure"].drift_score == 0.25 and got["sure"].prediction_entropy == 0.0 and got["sure"].confidence_std == pytest.approx(0, abs=1e-7)
    assert got["even"].drift_score == 1.0 and got["even"].confidence_std == pytest.approx(0.375)


def test_model_drift_needs_three_days_and_finds_a_fall(spark):
    falling = [("down", "POSITIVE", 0.9 - 0.1 * d + 0.001 * (d % 2), None, 24 * (6 - d)) for d in range(6)]
    slower = [("slow", "POSITIVE", 0.9, 100.0 + 90 * d, 24 * (6 - d)) for d in range(6)]
    short = [("short", "POSITIVE", 0.9, 1.0, 24 * d) for d in range(2)]
    got = {r.deployment_id: r for r in drift_stats.model_drift(logs(spark, *falling, *slower, *short), NOW).collect()}
    assert got["short"].error == "Insufficient data" and not got["short"].is_drift_detected and got["short"].drift_score == 0.0
    assert got["down"].confidence_declining and got["down"].time_slope is None and got["down"].drift_score == pytest.approx(0.1, abs=1e-3)
    assert got["slow"].performance_degrading and got["slow"].drift_score == pytest.approx(0.09) and got["slow"].confidence_slope == 0.0


def test_text_reference_against_itself_and_strangers(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rng = random.Random(9)
    ref = spark.createDataFrame([(i, " ".join(rng.choices(words, k=12))) for i in range(60)], "doc_id int, text string")
    reference = TextReference.fit(ref)
    same = reference.data_drift(ref, keys=(), column="text").first()
    assert same.drift_score == pytest.approx(0, abs=1e-9) and not same.is_drift_detected and same.confidence == pytest.approx(1)
    other = ref.select("doc_id", F.lit("zulu yankee").alias("text"))
    far = reference.data_drift(other, keys=(), column="text").first()
    assert far.cosine_similarity == 0.0 and far.is_drift_detected and far.confidence == 1.0
    assert (far.reference_avg_length, far.new_avg_length) == (12.0, 2.0)


def test_centroid_counts_texts_without_known_terms(spark):
    ref = spark.createDataFrame([("alpha beta",), ("alpha gamma",)], "text string")
    reference = TextReference.fit(ref)
    half = reference.weights.centroids(spark.createDataFrame([("alpha beta",), ("unknown",)], "text string")).first()
    full = reference.weights.centroids(spark.createDataFrame([("alpha beta",)], "text string")).first()
    assert half.texts == 2 and [2 * x for x in half.centroid] == pytest.approx(full.centroid)


def test_equal_columns_do_not_drift(spark):
    frame = spark.range(500).select((F.col("id") % 37).cast("double").alias("x"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"))
    rows = drift_columns.column_drift(frame, frame).collect()
    assert [r.drift_detected for r in rows] == [False, False]
    moved = frame.select((F.col("x") + 30).alias("x"), F.lit("z").alias("c"))
    summary = drift_columns.drift_summary(drift_columns.column_drift(frame, moved)).first()
    assert summary.dataset_drift and summary.drift_share == 1.0
    assert [f.feature for f in summary.drifted_features] == ["c", "x"]
    # disjoint categories are as far apart as the distance allows
    far = drift_columns.categorical_drift(frame, moved, ["c"]).first()
    assert far.score == pytest.approx(math.sqrt(math.log(2)))


def test_weighted_metrics_equal_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(10)
    rows = [(float(rng.randrange(3)), float(rng.choice([0, 0, 1, 3]))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "label double, predicted_label double")
    got = scoring.weighted_metrics(frame).first()
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        evaluator = MulticlassClassificationEvaluator(metricName=metric, predictionCol="predicted_label")
        assert got[name] == pytest.approx(evaluator.evaluate(frame))


def test_sample_predictions_and_external_model(spark):
    import pandas as pd

    def load():
        return lambda texts: pd.DataFrame({"neg": [0.0] * len(texts), "pos": texts.str.contains("good").astype(float) * 4 - 2})

    frame = spark.createDataFrame([(1, "a good film"), (2, "dull")], "id int, text string")
    got = {r.id: r for r in scoring.score_with(frame, load).collect()}
    assert got[1].predicted_sentiment == "POSITIVE" and got[2].predicted_sentiment == "NEGATIVE"
    assert got[1].confidence_score == 0.8808 and got[1].probabilities == [0.1192, 0.8808] and got[1].prediction_time >= 0


def test_metric_callback_gets_pairs_not_rows(spark):
    frame = spark.range(5000).select(F.lit("k").alias("k"), (F.col("id") % 2).alias("label"), (F.col("id") % 4 > 0).cast("bigint").alias("predicted_label"))

    def metric(labels, predictions, weights):
        return {"cells": len(labels), "rows": weights.sum()}

    row = batches.metric_callback(frame, metric, ["cells", "rows"], ["k"]).first()
    assert (row.cells, row.rows) == (3, 5000)


def test_newest_page_and_lookback_bound(spark):
    frame = logs(spark, *[("d", "POSITIVE", 0.5, 1.0, h) for h in (1, 1, 2, 24, 25)])
    assert [r.id for r in filters.newest(frame, "predicted_at", 2, offset=1).collect()] == [0, 2]
    assert filters.since(frame, "predicted_at", NOW, hours=24).count() == 4


def test_reference_is_the_whole_validation_split(spark):
    rows = [(i, "validation", "alpha beta") for i in range(1000)] + [(1000, "validation", "gamma gamma gamma"), (1001, "train", "delta")]
    texts = spark.createDataFrame(rows, "doc_id int, split string, text string")
    current = spark.createDataFrame([("d", "gamma gamma gamma")], "deployment_id string, input_text string")
    scores = []
    for chosen in (datasets.reference_texts(texts), datasets.reference_sample(texts, 1000)):
        scores.append(TextReference.fit(chosen).data_drift(current).first().drift_score)
    assert datasets.reference_texts(texts).count() == 1001 and scores[0] != scores[1] == 1.0


def test_a_shifted_column_is_spread_over_the_pieces(spark):
    from tallywatch.functions.ordered import bucket_of, value_bounds

    reference = spark.range(2000).select((F.col("id") / 2000).alias("x"))
    current = reference.select((F.col("x") + 5).alias("x"))
    bounds = value_bounds(reference.union(current), ["x"], 16)["x"]
    counts = [r["count"] for r in current.groupBy(bucket_of(F.col("x"), bounds).alias("b")).count().collect()]
    assert len(counts) >= 7 and max(counts) < 600
    found = drift_columns.numeric_drift(reference, current, ["x"]).first()
    assert found.ks_statistic == 1.0 and found.drift_detected


def test_large_samples_take_the_normal_limit(spark):
    from tallywatch.functions.numeric import student_t_p

    rows = [(0.02, 9_999), (0.02, 10_001), (0.0, 1_000_000), (0.5, 1_000_000)]
    got = [r.p for r in spark.createDataFrame(rows, "r double, n long").select(student_t_p(F.col("r"), F.col("n")).alias("p")).collect()]
    assert got[0] == pytest.approx(got[1], abs=1e-3) and got[2] == pytest.approx(1.0, abs=1e-6) and got[3] == 0.0


def test_sliding_rates_equal_counts_of_their_windows(spark):
    rows = [(NOW + timedelta(seconds=s),) for s in (0, 1, 59, 60, 61, 150, 299, 301)]
    found = series.rates(spark.createDataFrame(rows, "ts timestamp_ntz"), "ts", [], 120, 60).collect()
    for r in found:
        assert r.events == sum(r.window_start <= t < r.window_start + timedelta(seconds=120) for t, in rows)
    assert len(found) == 7


def test_requests_at_their_default_limits(spark):
    hits = [("h", i, NOW + timedelta(seconds=s)) for i, s in enumerate((0, 300, 601))]
    frame = spark.createDataFrame(hits, "input_hash string, id int, predicted_at timestamp_ntz")
    assert [r.seconds_since for r in requests.repeats_within(frame).orderBy("id").collect()] == [None, 300.0, 301.0]
    calls = [("c", NOW + timedelta(milliseconds=500 * i)) for i in range(110)] + [("d", NOW)]
    over = requests.over_rate(spark.createDataFrame(calls, "client string, ts timestamp_ntz"), ["client"], "ts").collect()
    assert {r.client for r in over} == {"c"} and len(over) == 10


def test_texts_are_not_shuffled_for_weights_and_read_once_for_drift(spark, small):
    from tallywatch.operators.drift_text import TermWeights, term_weights, text_sums

    docs = spark.read.parquet(f"{small}/documents.parquet")
    weights = TermWeights(("a", "b"), (1.0, 2.0))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan(term_weights(weights, docs))
    sums = plan(text_sums(weights, docs, ["lang"]))
    assert sums.count("FileScan") == 1 and sums.count("Exchange") == 1 and sums.index("Exchange") < sums.index("MapInArrow")


def test_text_sums_are_shuffled_as_lists_and_equal_those_of_single_texts(spark):
    from tallywatch.functions.text import word_count
    from tallywatch.operators.drift_text import TermWeights, term_weights, text_sums

    terms = ("alpha", "alpha beta", "beta", "straße", "ärger straße", "ärger", "i̇stanbul", "σας", "中中", "a1_", "a1_ b2", "½½", "the alpha", "x", "ll")
    weights = TermWeights(terms, tuple(1.0 + i for i in range(len(terms))))
    texts = ["ÄRGER straße İstanbul ΣΑΣ. x\u0085y ½½ 中中", "the alpha the beta q alpha beta", "alpha", None, "", "a1_ B2\u2003i'll alpha-beta", "alpha"] * 3
    rows = [(i, (None, "k", "l")[i % 3], text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id int, key string, text string").coalesce(1)
    key = {i: k for i, k, _ in rows}
    want = {}
    for r in term_weights(weights, frame).collect():
        cell = key[r.doc_id], "weight", terms.index(r.term)
        want[cell] = want.get(cell, 0.0) + r.weight
    for r in frame.select("key", word_count(F.col("text")).alias("n")).collect():
        want[r.key, "length", r.n] = want.get((r.key, "length", r.n), 0) + 1
    sums = text_sums(weights, frame, ["key"])
    assert {(r.key, r.kind, r.place): r.x for r in sums.collect()} == pytest.approx(want)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.index("inline") < plan.index("Exchange") < plan.index("MapInArrow")


@pytest.mark.parametrize("named", [10_000, 3])
def test_terms_of_frequent_words_are_the_most_frequent_terms(spark, monkeypatch, named):
    import random
    from collections import Counter

    from tallywatch.operators import drift_text

    monkeypatch.setattr(drift_text, "FREQUENT_WORDS", named)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60) for _ in range(1 + 300 // (i + 1))]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) + " aa bb" * (i % 5 == 0) for i in range(90)]
    counts, documents = Counter(), Counter()
    for text in texts:
        own = text.split()
        terms = own + [f"{a} {b}" for a, b in zip(own, own[1:])]
        counts.update(terms)
        documents.update(set(terms))
    frame = spark.createDataFrame([(x,) for x in [*texts, None]], "text string")
    for n in (1, 7, 40, 5000):
        got = [(r.term, r.corpus_count, r.document_count) for r in drift_text.fit_terms(frame, max_features=n).collect()]
        want = sorted(counts, key=lambda t: (-counts[t], t))[:n]
        assert sorted(got) == sorted((t, counts[t], documents[t]) for t in want)


def test_pairs_of_rare_words_are_not_counted(spark):
    from tallywatch.operators import drift_text

    rows = [(f"often common rare{i} seldom{i}",) for i in range(500)]
    frame = spark.createDataFrame(rows, "text string")
    assert sorted(r.term for r in drift_text.fit_terms(frame, max_features=2).collect()) == ["common", "often"]
    words = drift_text.frequent_words(frame, "text", 2, drift_text.ENGLISH_STOP_WORDS)
    counted = drift_text.add_terms_of(frame, "text", words).select(F.explode("terms")).distinct()
    assert sorted(r[0] for r in counted.collect()) == ["common", "often", "often common"]  # of 2,002 terms


def test_a_model_gets_texts_some_at_a_time_and_a_missing_score_is_null(spark, monkeypatch):
    import pandas as pd

    from tallywatch.functions import vectors
    from tallywatch.operators import scoring

    def load():
        def predict(texts):
            assert len(texts) < 1500  # of 2,001, with 4 KB each
            size = texts.str.len().to_numpy(dtype=float)
            return pd.DataFrame({"a": size - size, "b": size - 4000})

        return predict

    rows = [(i, "x" * (4000 + i % 2)) for i in range(2000)] + [(2000, None)]
    scored = scoring.score_with(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), load)
    assert scored.columns[:3] == ["doc_id", "text", "prediction_time"] and vectors.RUN_BYTES == 4 << 20
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) == 2001 and all(got[i].predicted_label == i % 2 and got[i].prediction_time >= 0 for i in range(2000))
    assert got[2000].predicted_label is None and got[2000].confidence_score is None and got[2000].text is None


def test_a_check_that_cannot_be_planned_is_no_result(spark, small, monkeypatch):
    from tallywatch.plans import monitor
    from tallywatch.plans.catalog import QUERIES

    frame = logs(spark, *[("d", "POSITIVE", 0.9, 1.0, i / 10) for i in range(12)])
    reference = TextReference.fit(spark.createDataFrame([("alpha beta",), ("gamma delta",)], "text string"))
    with pytest.raises(monitor.ChecksFailed, match="drift check data failed: .*input_text") as failed:  # there is no input_text
        monitor.run_monitor(reference, frame, str(NOW))
    assert set(failed.value.errors) == {"data"}
    assert sorted((r.drift_type, r.error) for r in failed.value.results.collect()) == [("concept", None), ("model", None)]

    def broken(*_):
        raise ValueError("out of order")

    monkeypatch.setattr(monitor, "concept_drift", broken)
    with pytest.raises(monitor.ChecksFailed, match="drift check concept failed: out of order"):
        QUERIES["G9_drift_monitor"](spark, small)
