"""The drift checks as a stream, from states that batches add to and checks merge.

A batch is reduced to two tables of partial states per deployment and hour: text sums (weights per term, texts per length) and
confidence parts with times. Both are written by day and batch, so a replayed batch overwrites its own part. A check adds up
the hours it looks back on; only rows of the hour in which the lookback begins are read again from the log. So a batch
costs what its own rows cost, and results do not depend on how rows fall into batches. Parts of the log whose texts could not be
summed when they came are summed by the next check that looks back on them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.functions.files import subfolders
from tallywatch.functions.sizes import stored
from tallywatch.operators.alerts import drift_alerts
from tallywatch.operators.drift_stats import concept_of, confidence_parts, merged_parts, trend_of
from tallywatch.operators.drift_text import TextReference, added_up, text_sums
from tallywatch.operators.filters import moment
from tallywatch.plans.monitor import MIN_ROWS, ChecksFailed, failure, result_rows
from tallywatch.streaming.jobs import log_rows, start_batches

KEY = "deployment_id"
PANE = ("predicted_on", "pane")
TIMES = "times double, mean_time double"
TASKS_PER_DAY = 8

log = logging.getLogger(__name__)


def lacks_columns(error: Exception) -> bool:
    """Whether a check cannot be planned because the log lacks what it reads; doing it again would not help."""
    return isinstance(error, AnalysisException) and (error.getCondition() or "").startswith("UNRESOLVED_COLUMN")


def with_pane(rows: DataFrame) -> DataFrame:
    """Rows with the hour they fall in."""
    return rows.withColumn("pane", F.date_trunc("hour", "predicted_at").cast("timestamp_ntz"))


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt to several tasks per day: a batch may be one file, which one task reads."""
    return rows.repartition(F.col("predicted_on"), F.pmod(F.hash(KEY, "predicted_at"), F.lit(TASKS_PER_DAY)))


def number_states(rows: DataFrame) -> DataFrame:
    """Confidence parts and times per deployment, hour and sentiment."""
    keys = [KEY, *PANE]
    times = rows.groupBy(*keys, "predicted_sentiment").agg(
        F.count("prediction_time").cast("double").alias("times"), F.avg("prediction_time").alias("mean_time")
    )
    # both sides are grouped alike; a NULL sentiment is one of its own
    parts = confidence_parts(rows, keys)
    same = [parts[k].eqNullSafe(times[k]) for k in [*keys, "predicted_sentiment"]]
    return parts.join(times, same).select(*[parts[c] for c in parts.columns], "times", "mean_time")


def daily_of(states: DataFrame) -> DataFrame:
    """Daily means per deployment from number states."""

    def mean(count: str, value: str) -> Column:
        return F.try_divide(F.sum(F.col(count) * F.col(value)), F.sum(F.when(F.col(count) > 0, F.col(count))))

    return states.groupBy(KEY, F.col("predicted_on").alias("prediction_date")).agg(
        mean("c", "mean").alias("avg_confidence"), F.sum("n").cast("bigint").alias("prediction_count"), mean("times", "mean_time").alias("avg_prediction_time")
    )


class States:
    """The log and the states under a path."""

    def __init__(self, spark: SparkSession, path: str, reference: TextReference, with_texts: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.reference, self.with_texts = spark, path, reference, with_texts

    def texts(self, rows: DataFrame) -> DataFrame:
        return text_sums(self.reference.weights, self.with_texts(rows), [KEY, *PANE], "input_text")

    def _put(self, df: DataFrame, name: str, batch: int) -> None:
        """Write a batch's part of every day it has; the same batch replaces what it wrote before."""
        writer = df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("predicted_on", "batch").parquet(f"{self.path}/{name}")

    def days(self, name: str, since: str) -> list[str]:
        """Folders of the days from `since` on."""
        return [d for d in subfolders(self.spark, f"{self.path}/{name}") if d.startswith("predicted_on=") and d >= f"predicted_on={since}"]

    def parts(self, name: str, since: str) -> set[str]:
        """Folders of batches by day, from `since` on."""
        return {f"{d}/{b}" for d in self.days(name, since) for b in subfolders(self.spark, f"{self.path}/{name}/{d}") if b.startswith("batch=")}

    def fill_texts(self, since: str, batch: int, schema: str) -> None:
        """Sum the texts of parts of the log up to this batch that have no sums yet, because summing them failed when they came."""
        missing: dict[int, list[str]] = {}
        for part in self.parts("log", since) - self.parts("texts", since):
            missing.setdefault(int(part.rsplit("batch=", 1)[1]), []).append(f"{self.path}/log/{part}")
        reader = self.spark.read.schema(f"{schema}, predicted_on date, batch int").option("basePath", f"{self.path}/log")
        for number in sorted(n for n in missing if n <= batch):
            self._put(self.texts(with_pane(reader.parquet(*missing[number]).drop("batch"))), "texts", number)

    def get(self, name: str, since: str, batch: int, schema: str) -> DataFrame:
        """What batches up to this one wrote for the days from `since` on; only their folders are listed."""
        days = self.days(name, since)
        schema = f"{schema}, predicted_on date, batch int"
        if not days:
            return self.spark.createDataFrame([], schema).drop("batch")
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}")
        return reader.parquet(*[f"{self.path}/{name}/{d}" for d in days]).filter(F.col("batch") <= batch).drop("batch")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add a batch to the log and the states; where its texts cannot be summed, `fill_texts` does it or tells why."""
        kept = spread(log_rows(rows)).persist()
        try:
            self._put(kept, "log", batch)
            panes = with_pane(kept)
            self._put(number_states(panes), "numbers", batch)
            try:
                self._put(self.texts(panes), "texts", batch)
            except Exception:  # the other checks go on without texts
                log.exception("texts of batch %s are not summed yet", batch)
        finally:
            kept.unpersist()


def watch_drift(
    stream: DataFrame, reference: TextReference, path: str, checkpoint: str,
    with_texts: Callable[[DataFrame], DataFrame] = lambda logs: logs, as_of: str | None = None, hours: int = 24, days: int = 7,
    min_rows: int = MIN_ROWS,
) -> StreamingQuery:
    """Run the drift checks whenever rows arrive, over all that came so far, against a fixed reference.

    `as_of` defaults to the newest time of the batch; `with_texts` adds `input_text` to log rows that do not carry it. Results
    and alerts are files per batch. Each check writes on its own; one that fails leaves a row with its error. When all have
    written, `ChecksFailed` ends the query, and a restart does the batch again; only a check whose columns the log lacks,
    which would fail again, lets the stream go on.
    """
    log_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log_rows(stream).schema if f.name != "predicted_on")
    kind = stream.schema[KEY].dataType.simpleString()
    of_numbers = f"{KEY} {kind}, pane timestamp_ntz, predicted_sentiment string, n double, c double, mean double, var double, low double, {TIMES}"
    of_texts = f"{KEY} {kind}, pane timestamp_ntz, kind string, place long, x double"

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = States(spark, path, reference, with_texts)
        states.add(batch, batch_id)
        newest = as_of or batch.filter(F.col(KEY).isNotNull()).agg(F.max("predicted_at")).first()[0]
        if newest is None:
            return

        def looked_back(name: str, schema: str, made: Callable[[DataFrame], DataFrame], **back: int) -> DataFrame:
            """States of whole hours of the lookback, and those of the rows in the hour in which it begins."""
            low = moment(newest) - F.make_dt_interval(F.lit(back.get("days", 0)), F.lit(back.get("hours", 0)), F.lit(0), F.lit(0.0))
            begin, hour, aligned = spark.range(1).select(
                low.cast("date").cast("string"), F.date_trunc("hour", low).cast("timestamp_ntz").cast("string"), F.date_trunc("hour", low).cast("timestamp_ntz") == low
            ).first()
            if name == "texts":
                states.fill_texts(begin, batch_id, log_schema)
            kept = states.get(name, begin, batch_id, schema)
            if aligned:
                return kept.filter(F.col("pane") >= moment(hour))
            rows = with_pane(states.get("log", begin, batch_id, log_schema)).filter(F.col("pane") == moment(hour))
            return kept.filter(F.col("pane") > moment(hour)).unionByName(made(rows.filter(F.col("predicted_at") >= low)))

        recent = stored(looked_back("numbers", of_numbers, number_states, hours=hours), "recent-numbers")
        busy = recent.groupBy(KEY).agg(F.sum("n").alias("_n")).filter(F.col("_n") >= min_rows).select(KEY)

        def data() -> DataFrame:
            sums = added_up(looked_back("texts", of_texts, states.texts, hours=hours), [KEY])
            return result_rows(reference.drift_of(stored(sums.join(busy, KEY, "left_semi"), "text-sums"), [KEY]), "data", F.col("confidence"))

        def concept() -> DataFrame:
            found = concept_of(merged_parts(recent, [KEY]), [KEY])
            return result_rows(found.join(busy, KEY, "left_semi"), "concept", F.col("drift_score"))

        def model() -> DataFrame:
            daily = daily_of(looked_back("numbers", of_numbers, number_states, days=days))
            return result_rows(trend_of(daily).join(busy, KEY, "left_semi"), "model", F.col("confidence"))

        errors = {}
        for name, build in (("data", data), ("concept", concept), ("model", model)):
            target = f"{path}/results/batch={batch_id}/check={name}"
            try:
                build().write.mode("overwrite").parquet(target)
            except Exception as error:  # the other checks go on; the failure is a row among the results
                log.exception("drift check %s failed", name)
                failure(spark, name, error).write.mode("overwrite").parquet(target)
                errors |= {} if lacks_columns(error) else {name: error}
        results = spark.read.parquet(f"{path}/results/batch={batch_id}")
        drift_alerts(results.drop("error")).write.mode("overwrite").parquet(f"{path}/alerts/batch={batch_id}")
        if errors:
            raise ChecksFailed(errors)

    return start_batches(stream, check, checkpoint)
