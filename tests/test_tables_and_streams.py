from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import folds
from tallywatch.sources import tables
from tallywatch.sources.canonical import Tables, alert_events_from_lines
from tallywatch.streaming import drift_watch, jobs, lifecycle

NOW = datetime(2024, 5, 10, 12)


def test_splits_survive_a_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1, "train"), ("b", None, "test")], "text string, label int, split string")
    tables.save_splits(frame, str(tmp_path / "d"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "d")).collect())) == [("a", 1, "train"), ("b", None, "test")]


def test_load_or_build_uses_the_saved_copy(spark, tmp_path):
    path, calls = str(tmp_path / "d"), []

    def build():
        calls.append(1)
        return spark.createDataFrame([(len(calls), "train")], "n int, split string")

    assert tables.load_or_build(spark, path, build).first().n == 1
    assert tables.load_or_build(spark, path, build).first().n == 1
    assert tables.load_or_build(spark, path, build, force_reload=True).first().n == 2


@pytest.mark.parametrize("fmt", ["json", "csv", "orc"])
def test_load_splits_reads_other_formats(spark, tmp_path, fmt):
    for name in ("train", "test"):
        spark.createDataFrame([(name * 2, 1)], "text string, label int").write.option("header", "true").format(fmt).save(str(tmp_path / name))
    options = {"header": "true"} if fmt == "csv" else {}
    got = tables.load_splits(spark, {n: str(tmp_path / n) for n in ("train", "test")}, fmt, **options)
    assert sorted((r.text, r.split) for r in got.collect()) == [("testtest", "test"), ("traintrain", "train")]


def test_appended_rows_get_their_defaults(spark, tmp_path):
    now = F.lit(str(NOW)).cast("timestamp_ntz")
    alert = spark.createDataFrame([("a", "ERROR", "t", None), ("b", "ERROR", "t", "HIGH")], "id string, alert_type string, title string, severity string")
    tables.append_rows(alert, "monitoring_alerts", str(tmp_path / "alerts"), now)
    tables.append_rows(alert.limit(1), "monitoring_alerts", str(tmp_path / "alerts"), now)
    rows = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert len(rows) == 3 and {r.severity for r in rows} == {"MEDIUM", "HIGH"}
    assert {(r.status, r.triggered_at) for r in rows} == {("ACTIVE", NOW)}
    deployment = spark.createDataFrame([("d", "r", "n", "1")], "id string, experiment_run_id string, deployment_name string, version string")
    row = tables.with_defaults(deployment, "model_deployments", now).first()
    assert (row.status, row.replicas, row.error_rate, row.api_version, row.health_status) == ("DEPLOYING", 1, 0.0, "v1", "UNKNOWN")
    with pytest.raises(ValueError):
        tables.with_defaults(deployment.drop("version"), "model_deployments")


def test_logging_predictions_skips_rows_without_deployment(spark, tmp_path):
    frame = spark.createDataFrame([("r1", "text", "d", NOW), ("r2", "text", None, NOW)], "request_id string, input_text string, deployment_id string, predicted_at timestamp_ntz")
    tables.log_predictions(frame, str(tmp_path / "log"))
    rows = spark.read.parquet(str(tmp_path / "log")).collect()
    assert [(r.request_id, r.input_hash, str(r.predicted_on)) for r in rows] == [("r1", "982d9e3eb996f559e633f4d194def3761d909f5a3b647d1a851fead67c32c9d1", "2024-05-10")]


def test_json_export_keeps_every_row_and_stringifies_times(spark, tmp_path):
    frame = spark.createDataFrame([(1, NOW, {"a": 0.5}), (2, None, None)], "id int, at timestamp_ntz, p map<string,double>")
    tables.export_json(frame, str(tmp_path / "j"))
    rows = {r.id: r for r in spark.read.json(str(tmp_path / "j")).collect()}
    assert rows[1]["at"] == "2024-05-10 12:00:00" and rows[1].p.a == 0.5 and rows[2]["at"] is None


def test_prediction_log_filters_reach_the_scan(spark, small):
    from tallywatch.operators.usage import prediction_statistics

    plan = prediction_statistics(Tables(spark, small).logs, "2024-01-31 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-30" in plan and "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_unread_joins_are_dropped(spark, small):
    from tallywatch.operators.alerts import active_alert_gauge

    plan = active_alert_gauge(Tables(spark, small).alerts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def _arrive(frame, folder, name):
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_ingest_counts_every_file_once_over_restarts(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "id int, deployment_id string, predicted_at timestamp_ntz"

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        jobs.ingest(stream, out, check).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    _arrive(spark.createDataFrame([(1, "d", NOW), (2, None, NOW)], schema), source, "a")
    assert run() == [1]
    assert run() == [1]
    _arrive(spark.createDataFrame([(3, "d", NOW + timedelta(days=1))], schema), source, "b")
    assert run() == [1, 3]


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "request_id string, predicted_at timestamp_ntz"
    for i, rows in enumerate([[("a", NOW), ("a", NOW), ("b", NOW)], [("a", NOW + timedelta(minutes=1)), ("c", NOW)]]):
        _arrive(spark.createDataFrame(rows, schema), source, f"f{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        jobs.start(jobs.drop_repeats(stream), out, check).awaitTermination()
    assert sorted(r.request_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_followed_alerts_equal_the_batch_fold_over_many_batches(spark, small, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    t = Tables(spark, small)
    lines = t.raw("lineitem")
    kind = t.alert_events.schema["happened_at"].dataType.simpleString()
    expected = folds.alert_lifecycle(t.alerts, t.alert_events)
    for i in range(5):
        _arrive(lines.filter(F.col("l_linenumber") % 5 == i), source, f"f{i}")
        stream = spark.readStream.schema(lines.schema).option("recursiveFileLookup", "true").parquet(source)
        lifecycle.follow_alerts(alert_events_from_lines(stream), out, check, buckets=8).awaitTermination()
    got = lifecycle.followed_alerts(spark, out, t.alerts, kind)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert spark.read.parquet(f"{out}/current").count() == t.alert_events.select("alert_id").distinct().count()


def test_states_of_resolved_alerts_fall_and_late_actions_still_count(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "alert_id long, seq long, action string, actor string, notes string, happened_at timestamp_ntz"
    first = [(i, 10 + i, "resolve" if i < 40 else "acknowledge", f"u{i}", "why", NOW) for i in range(50)]
    late = [(1, 5, "acknowledge", "early", None, NOW), (2, 99, "resolve", "again", "", NOW + timedelta(days=1))]
    rows, sizes = [], []
    for i, batch in enumerate([first, late, [(45, 100, "acknowledge", "second", None, NOW)]]):
        rows += batch
        _arrive(spark.createDataFrame(batch, schema), source, f"f{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        query = lifecycle.follow_alerts(stream, out, check, buckets=4, resolved_ms=1)
        query.awaitTermination()
        sizes.append(sum(op["numRowsTotal"] for p in query.recentProgress[-1:] for op in p["stateOperators"]))
    alerts = spark.createDataFrame([(i, "ACTIVE") for i in range(51)], "id long, status string")
    expected = folds.alert_lifecycle(alerts, spark.createDataFrame(rows, schema))
    got = lifecycle.followed_alerts(spark, out, alerts)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert sizes[0] > sizes[-1] and sizes[-1] < 40  # of 50 alerts 40 are resolved


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "alert_id long, seq long, action string, actor string, notes string, happened_at timestamp_ntz"
    _arrive(spark.createDataFrame([(i, i, "acknowledge", "a", None, NOW) for i in range(9)], schema), source, "a")
    for attempt in ("one", "two"):  # a lost checkpoint: everything comes again as batch 0
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        lifecycle.follow_alerts(stream, out, str(tmp_path / attempt), buckets=4).awaitTermination()
    assert spark.read.parquet(f"{out}/current").count() == 9


def test_drift_watch_keeps_going_when_a_check_fails(spark, tmp_path):
    from tallywatch.operators.drift_text import TextReference

    reference = TextReference.fit(spark.createDataFrame([("alpha beta",), ("gamma delta",)], "text string"))
    schema = "id int, deployment_id string, predicted_sentiment string, confidence_score double, prediction_time double, predicted_at timestamp_ntz"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    _arrive(spark.createDataFrame([(i, "d", "POSITIVE", 0.9, 1.0, NOW) for i in range(12)], schema), source, "a")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    # there is no input_text, so the text check fails
    drift_watch.watch_drift(stream, reference, out, check).awaitTermination()
    found = spark.read.parquet(f"{out}/results").collect()
    assert {r.drift_type for r in found if r.error is None} == {"concept", "model"}
    assert [(r.drift_type, r.deployment_id) for r in found if r.error] == [("data", None)]
    assert [r.alert_type for r in spark.read.parquet(f"{out}/alerts").collect()] == ["CONCEPT_DRIFT"]


def test_drift_watch_looks_back_over_all_batches(spark, tmp_path):
    from tallywatch.operators.drift_stats import model_drift
    from tallywatch.operators.drift_text import TextReference

    reference = TextReference.fit(spark.createDataFrame([("alpha beta",), ("gamma delta",)], "text string"))
    schema = "id int, deployment_id string, predicted_sentiment string, confidence_score double, prediction_time double, predicted_at timestamp_ntz, input_text string"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    everything = []
    for day in range(5):
        rows = [(100 * day + i, "d", "POSITIVE", 0.95 - 0.15 * day, 1.0, NOW + timedelta(days=day, minutes=i), "alpha") for i in range(12)]
        everything += rows
        _arrive(spark.createDataFrame(rows, schema), source, f"f{day}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        drift_watch.watch_drift(stream, reference, out, check).awaitTermination()
    moment = str(max(r[5] for r in everything))
    batch = model_drift(spark.createDataFrame(everything, schema), moment).first()
    found = spark.read.parquet(f"{out}/results").filter("batch = 4 AND drift_type = 'model'").first()
    assert batch.is_drift_detected and found.is_drift_detected and found.drift_score == pytest.approx(batch.drift_score)


def test_a_batch_in_one_file_is_dealt_to_several_tasks(spark):
    schema = "id int, deployment_id string, predicted_at timestamp_ntz"
    rows = spark.createDataFrame([(i, "d", NOW + timedelta(hours=i)) for i in range(400)], schema).coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so few rows would be put together again
    try:
        dealt = drift_watch.spread(jobs.log_rows(rows)).select("id", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r.id for r in dealt) == list(range(400)) and len({r.task for r in dealt}) == 4


WATCHED = "id int, deployment_id string, predicted_sentiment string, confidence_score double, prediction_time double, predicted_at timestamp_ntz"


def test_a_failed_check_ends_the_watch_and_is_done_again(spark, tmp_path, monkeypatch):
    from pyspark.errors import StreamingQueryException

    from tallywatch.operators.drift_text import TextReference

    reference = TextReference.fit(spark.createDataFrame([("alpha beta",), ("gamma delta",)], "text string"))
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [(i, "d", "POSITIVE", 0.9, 1.0, NOW, "alpha") for i in range(12)]
    _arrive(spark.createDataFrame(rows, f"{WATCHED}, input_text string"), source, "a")

    def run():
        stream = spark.readStream.schema(f"{WATCHED}, input_text string").option("recursiveFileLookup", "true").parquet(source)
        drift_watch.watch_drift(stream, reference, out, check).awaitTermination()
        return {r.drift_type: r.error for r in spark.read.parquet(f"{out}/results").collect()}

    def broken(*_):
        raise ValueError("out of order")

    with monkeypatch.context() as m:
        m.setattr(drift_watch, "concept_of", broken)
        with pytest.raises(StreamingQueryException, match="drift check concept failed: out of order"):
            run()
    assert {r.drift_type: r.error for r in spark.read.parquet(f"{out}/results").collect()}["data"] is None
    assert run() == {"data": None, "concept": None, "model": None}


def test_texts_that_could_not_be_summed_are_not_left_out_later(spark, tmp_path):
    from tallywatch.operators.drift_text import TextReference

    reference = TextReference.fit(spark.createDataFrame([("alpha beta",), ("gamma delta",)], "text string"))
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    everything = []
    for i, text in enumerate(["alpha beta", "gamma"]):
        rows = [(20 * i + n, "d", "POSITIVE", 0.9, 1.0, NOW + timedelta(minutes=n)) for n in range(12)]
        everything += [(*r, text) for r in rows]
        _arrive(spark.createDataFrame(rows, WATCHED), source, f"f{i}")
        stream = spark.readStream.schema(WATCHED).option("recursiveFileLookup", "true").parquet(source)
        # the texts of the first batch are not there when it comes
        with_texts = (lambda logs: logs.withColumn("input_text", F.when(F.col("id") < 20, "alpha beta").otherwise("gamma"))) if i else (lambda logs: logs)
        drift_watch.watch_drift(stream, reference, out, check, with_texts).awaitTermination()
    found = spark.read.parquet(f"{out}/results").filter("batch = 1 AND drift_type = 'data'").first()
    expected = reference.data_drift(spark.createDataFrame(everything, f"{WATCHED}, input_text string")).first()
    assert found.error is None and found.drift_score == pytest.approx(expected.drift_score)


def test_a_failed_check_is_no_result_of_the_streamed_drift(spark, small, monkeypatch):
    from tallywatch.plans.catalog import QUERIES
    from tallywatch.plans.monitor import RESULT, ChecksFailed

    class Done:
        def awaitTermination(self):  # noqa: N802
            pass

    def watched(stream, reference, path, checkpoint, *_, **__):
        good, bad = ("dep-1", "model", False, 0.0, 1.0, "{}", None), (None, "data", None, None, None, None, "no texts")
        for batch, row in enumerate([good, bad]):
            spark.createDataFrame([row], RESULT).write.parquet(f"{path}/results/batch={batch}/check={row[1]}")
        return Done()

    monkeypatch.setattr(drift_watch, "watch_drift", watched)
    with pytest.raises(ChecksFailed, match="drift check data failed: no texts"):
        QUERIES["R5_streamed_drift"](spark, small)


def _actions(rows):
    import pyarrow as pa

    names = ("slot", "alert_id", "seq", "action", "actor", "notes", "happened_at")
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def test_folds_of_parts_are_those_of_all_actions():
    import random

    import pyarrow as pa
    from pyspark.sql.types import StringType

    schema, pick = lifecycle.folds_schema(StringType()), random.Random(1)
    seqs = pick.sample(range(2**60, 2**60 + 10_000), 900)  # more than a double tells apart
    rows = []
    for seq in seqs:
        alert = pick.choice([None, "", *[f"a{i}" for i in range(40)]])
        action, notes = pick.choice(["acknowledge", "resolve", "other", None]), pick.choice([None, "", f"n{seq}"])
        rows.append((0, alert, pick.choice([seq, seq, None]), action, pick.choice([None, f"u{seq}"]), notes, f"t{seq}"))

    def first(found, sign):
        return min(found, key=lambda r: sign * r[2], default=(None,) * 7)

    expected = {}
    for alert in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == alert and r[2] is not None]
        ack, resolves = first([r for r in own if r[3] == "acknowledge"], 1), [r for r in own if r[3] == "resolve"]
        last, noted = first(resolves, -1), first([r for r in resolves if r[5]], -1)
        expected[alert] = (ack[2], ack[4], ack[6], first(resolves, 1)[2], last[2], last[4], last[6], noted[2], noted[5])
    parts = [lifecycle.of_actions(pa.Table.from_batches([_actions(rows[i : i + 100])]), schema) for i in range(0, 900, 100)]
    folds = [lifecycle.fold(p).select(schema.names) for p in parts]
    got = lifecycle.fold(pa.concat_tables([*folds, folds[3]])).to_pylist()
    assert len(got) == len(expected) and {r.pop("alert_id"): tuple(r.values()) for r in got} == expected


def test_folds_of_a_slot_go_one_by_one():
    import pyarrow as pa
    from pyspark.sql.types import StringType

    class Store:
        def __init__(self):
            self.value, self.timers, self.calls = None, set(), 0
            self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

        def getValueState(self, name, schema):  # noqa: N802
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    class Clock:
        def getCurrentProcessingTimeInMs(self):  # noqa: N802
            return now

    schema, store = lifecycle.folds_schema(StringType()), Store()
    fold = lifecycle.AlertFold(schema, idle_ms=100, resolved_ms=10)
    fold.init(store)

    def held():
        return sorted(pa.ipc.open_stream(store.value[1]).read_all().column("alert_id").to_pylist()) if store.value else []

    def act(*rows):
        packed = [{"pack": p} for b in lifecycle.packs(schema)(iter([_actions(rows)])) for p in b.column("pack").to_pylist()]
        (out,) = fold.handleInputRows((0,), iter(packed), Clock())
        due = {t for t in store.timers if t <= now}
        for t in due:  # as the engine does, after the rows
            store.timers.discard(t)
            list(fold.handleExpiredTimer((0,), Clock(), None))
        found = pa.ipc.read_record_batch(pa.py_buffer(out["pack"]), schema).to_pylist()
        return {r["alert_id"]: (r["first_ack"], r["first_resolve"]) for r in found}

    now = 1000
    assert act(*[(0, f"r{i}", i, "resolve", "u", None, "t") for i in range(20)], (0, "open", 50, "acknowledge", "u", None, "t")) == {
        **{f"r{i}": (None, i) for i in range(20)}, "open": (50, None)
    }
    assert store.calls == 1 and len(held()) == 21 and store.timers == {1010}
    now = 1005
    assert act((0, "r1", 0, "acknowledge", "u", None, "t"), (0, "r2", 70, "acknowledge", "u", None, "t")) == {"r1": (0, 1), "r2": (70, 2)}
    now = 1010  # what was resolved goes, and a late action begins anew
    assert act((0, "r1", 99, "acknowledge", "u", None, "t")) == {"r1": (99, None)}
    assert held() == ["open", "r1"] and store.timers == {1100}
    now = 1100
    list(fold.handleExpiredTimer((0,), Clock(), None))
    assert held() == ["r1"] and 1110 in store.timers
    now = 1110
    list(fold.handleExpiredTimer((0,), Clock(), None))
    assert store.value is None


def test_a_batch_calls_the_state_once_per_slot(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "alert_id long, seq long, action string, actor string, notes string, happened_at date"
    rows = [(i % 300, i, "resolve" if i % 3 else "acknowledge", f"u{i}", None, NOW.date()) for i in range(900)] + [(None, 5, "resolve", "u", "n", None)]
    for i in range(2):
        _arrive(spark.createDataFrame(rows[i::2], schema), source, f"f{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        query = lifecycle.follow_alerts(stream, out, check, buckets=4, slots=8)
        query.awaitTermination()
        assert 0 < sum(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"]) <= 8 * 3  # with timers
    alerts = spark.createDataFrame([(i, "ACTIVE") for i in range(301)], "id long, status string")
    expected = folds.alert_lifecycle(alerts, spark.createDataFrame(rows, schema))
    got = lifecycle.followed_alerts(spark, out, alerts, "date")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert spark.read.parquet(f"{out}/current").count() == 301
