"""The alert lifecycle as a stateful stream, and the table of current states it keeps.

The state holds the fold of every alert's actions so far. An alert's fold goes when the alert has been idle for a time, or a time
after it was resolved, so the state does not grow with the alerts of the past. Folds merge, and each batch's are merged into the
table, so an action that comes after its alert's state has gone still meets what was known.

A call from Python to the state store costs more than folding thousands of actions, so a value holds the folds of a slot of
alerts. A task folds the actions it reads and packs the folds by slot, as Arrow record batches; `AlertFold` is called once per
slot, and its timer goes off when the first fold of the slot is to go.

The table is partitioned by a hash of the alert. A batch merges its alerts with those of the partitions it touches, writes the
result aside and then over these partitions. A replayed batch finds what it wrote aside, or an untouched table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import TimerValues
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType

from tallywatch.functions.files import existing, finished
from tallywatch.operators.folds import ALERT_STATE, alert_state

FOLD = (
    "first_ack long, ack_actor string, ack_at string, first_resolve long, last_resolve long, resolve_actor string, resolve_at string, "
    "note_seq long, resolve_notes string"
)
FIELDS = {name: kind for name, kind in (part.split() for part in FOLD.split(", "))}
# the field whose least or greatest value says which part of an alert's actions a field is taken from
LEAST, GREATEST = ("first_ack", "first_resolve"), ("last_resolve", "note_seq")
DECIDES = {
    "first_ack": "first_ack", "ack_actor": "first_ack", "ack_at": "first_ack", "first_resolve": "first_resolve",
    "last_resolve": "last_resolve", "resolve_actor": "last_resolve", "resolve_at": "last_resolve",
    "note_seq": "note_seq", "resolve_notes": "note_seq",
}
TIMES = {"touched": pa.int64(), "resolved": pa.int64()}  # clock at the last action, and when the state first saw a resolve
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",  # else batches without rows, to look for timers, never end
}
DAY_MS = 24 * 3600 * 1000
SLOTS = 4096
PACK_BYTES = 32 << 20


def folds_schema(alert_id: DataType, happened_at: DataType = StringType()) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()} | dict.fromkeys(("ack_at", "resolve_at"), to_arrow_type(happened_at))
    return pa.schema([("alert_id", to_arrow_type(alert_id)), *[(name, kinds.get(name, kinds[kind])) for name, kind in FIELDS.items()]])


def of_actions(actions: pa.Table, schema: pa.Schema) -> pa.Table:
    """Every action as the fold of itself, with its slot; an action without a place in the order changes nothing."""
    seq, actor, at, notes = (actions.column(c) for c in ("seq", "actor", "happened_at", "notes"))
    none = pa.scalar(None, pa.int64())
    acknowledged = pc.if_else(pc.equal(actions.column("action"), "acknowledge"), seq, none)
    resolved = pc.if_else(pc.equal(actions.column("action"), "resolve"), seq, none)
    noted = pc.if_else(pc.greater(pc.binary_length(notes), 0), resolved, none)
    columns = [actions.column("alert_id"), acknowledged, actor, at, resolved, resolved, actor, at, noted, notes]
    return pa.Table.from_arrays(columns, names=schema.names).cast(schema).append_column("slot", actions.column("slot"))


def fold(parts: pa.Table, kept: Sequence[str] = ()) -> pa.Table:
    """One fold per alert from several of parts of its actions, in the order in which the alerts first come; parts may overlap.

    Columns `kept` are those of an alert's first part. Of parts with equal places in the order the first one counts.
    """
    coded = parts.column("alert_id").combine_chunks().dictionary_encode(null_encoding="encode")
    code, n = coded.indices.to_numpy(), len(coded.dictionary)

    def last_put(rows: np.ndarray) -> pa.Array:
        """Per alert the last of these rows, if there is one."""
        found = np.full(n, -1, dtype=np.int64)
        found[code[rows]] = rows
        return pa.array(found, mask=found < 0)

    def deciding(name: str) -> pa.Array:
        """Per alert the part with the least or greatest value."""
        value = parts.column(name).combine_chunks()
        seq = value.drop_null().to_numpy()
        order = np.argsort(seq, kind="stable")[::-1] if name in LEAST else len(seq) - 1 - np.argsort(seq[::-1], kind="stable")
        return last_put(np.flatnonzero(value.is_valid())[order])

    places = {name: deciding(name) for name in LEAST + GREATEST}
    columns = {"alert_id": coded.dictionary} | {name: parts.column(name).take(places[DECIDES[name]]) for name in FIELDS}
    first = last_put(np.arange(len(code))[::-1])
    return pa.table(columns | {name: parts.column(name).take(first) for name in kept})


def one_batch(table: pa.Table) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns], schema=table.schema)


def packs(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fold the actions that a task reads, some megabytes at a time, to packs by slot."""

    def packed(read: list[pa.RecordBatch]) -> pa.RecordBatch:
        folds = fold(of_actions(pa.Table.from_batches(read), schema), ["slot"])
        folds = one_batch(folds.take(pc.sort_indices(folds.column("slot"))))
        slots, folds = folds.column("slot").to_numpy(), folds.select(schema.names)
        begin = np.flatnonzero(np.diff(slots, prepend=slots[0] - 1))
        ends = [*begin[1:], len(slots)]
        own = [folds.slice(a, b - a).serialize().to_pybytes() for a, b in zip(begin, ends)]
        return pa.RecordBatch.from_arrays([pa.array(slots[begin], pa.int32()), pa.array(own, pa.binary())], names=["slot", "pack"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, size = [], 0
        for batch in batches:
            if batch.num_rows:
                read.append(batch)
                size += batch.nbytes
            if size >= PACK_BYTES:
                yield packed(read)
                read, size = [], 0
        if read:
            yield packed(read)

    return work


def unpacked(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column("pack"):
                yield pa.ipc.read_record_batch(pack.as_buffer(), schema)

    return work


class AlertFold(StatefulProcessor):
    """Folds of every slot's alerts; gives the folds that a batch changed."""

    def __init__(self, schema: pa.Schema, idle_ms: int, resolved_ms: int):
        self.schema, self.idle_ms, self.resolved_ms = schema, idle_ms, resolved_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("folds", "due long, folds binary")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        new = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(row["pack"]), self.schema) for row in rows])
        due, known = self._known(now)
        every = fold(pa.concat_tables([known, new], promote_options="default"), list(TIMES))
        changed = pc.is_in(every.column("alert_id"), value_set=new.column("alert_id").combine_chunks())
        first = pc.and_(pc.is_null(every.column("resolved")), pc.is_valid(every.column("first_resolve")))
        times = {"touched": pc.if_else(changed, now, every.column("touched")), "resolved": pc.if_else(first, now, every.column("resolved"))}
        folds = every.select(self.schema.names)
        self._keep(pa.table(dict(zip(folds.column_names, folds.columns)) | times), due, now)
        yield Row(slot=key[0], pack=one_batch(folds.filter(changed)).serialize().to_pybytes())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        due, known = self._known(now)
        if due is not None and due <= now:  # else rows of this batch came before the timer
            self._keep(known, due, now)
        return iter(())

    def close(self) -> None:
        pass

    def _ends(self, folds: pa.Table) -> pa.ChunkedArray:
        """When each fold is to go."""
        return pc.min_element_wise(pc.add(folds.column("touched"), self.idle_ms), pc.add(folds.column("resolved"), self.resolved_ms))

    def _known(self, now: int) -> tuple[int | None, pa.Table]:
        """The slot's timer and its folds that are not to go yet."""
        held = self.held.get()  # None without state: a call to the store costs more than the folds
        if held is None:
            return None, pa.schema([*self.schema, *TIMES.items()]).empty_table()
        folds = pa.ipc.open_stream(pa.py_buffer(held[1])).read_all()
        return held[0], folds.filter(pc.greater(self._ends(folds), now))

    def _keep(self, folds: pa.Table, due: int | None, now: int) -> None:
        if not len(folds):
            self.held.clear()
            return
        end = pc.min(self._ends(folds)).as_py()
        if due is None or due <= now or end < due:  # a timer that goes off too early finds nothing and is set again
            if due is not None and due > now:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(end)
            due = end
        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, folds.schema) as writer:
            writer.write_table(folds.combine_chunks())
        self.held.update((due, stream.getvalue().to_pybytes()))


def merged(folds: DataFrame) -> DataFrame:
    """One fold per alert from several of parts of its actions; parts may overlap."""
    return folds.groupBy("alert_id", "bucket").agg(
        F.min("first_ack").alias("first_ack"),
        F.min_by("ack_actor", "first_ack").alias("ack_actor"),
        F.min_by("ack_at", "first_ack").alias("ack_at"),
        F.min("first_resolve").alias("first_resolve"),
        F.max("last_resolve").alias("last_resolve"),
        F.max_by("resolve_actor", "last_resolve").alias("resolve_actor"),
        F.max_by("resolve_at", "last_resolve").alias("resolve_at"),
        F.max("note_seq").alias("note_seq"),
        F.max_by("resolve_notes", "note_seq").alias("resolve_notes"),
    )


def follow_alerts(
    events: DataFrame, path: str, checkpoint: str, buckets: int = 64, idle_ms: int = 30 * DAY_MS, resolved_ms: int = DAY_MS,
    slots: int = SLOTS,
) -> StreamingQuery:
    """Fold the stream of actions (alert_id, seq, action, actor, notes, happened_at) and keep the table of current states.

    An alert's state is dropped `idle_ms` after its last action and `resolved_ms` after it was resolved, by the clock of the
    stream. Several actions of one alert in a batch are folded together; the batch rewrites only the slots of the state and the
    partitions it touches. A checkpoint keeps its number of `slots`.
    """
    spark = events.sparkSession
    alert_id, at = events.schema["alert_id"].dataType, events.schema["happened_at"].dataType
    if not isinstance(at, (TimestampNTZType, DateType)):  # these become text when few are left
        at = StringType()
    kind, schema = alert_id.simpleString(), folds_schema(alert_id, at)
    slot = F.pmod(F.xxhash64("alert_id"), F.lit(slots)).cast("int").alias("slot")
    actions = events.select(
        slot, "alert_id", F.col("seq").cast("long").alias("seq"), "action", "actor", "notes", F.col("happened_at").cast(at).alias("happened_at")
    )
    changes = actions.mapInArrow(packs(schema), "slot int, pack binary").groupBy("slot").transformWithState(
        AlertFold(schema, idle_ms, resolved_ms), "slot int, pack binary", "update", "processingTime"
    )
    times = {c: F.col(c).cast("string") for c in ("ack_at", "resolve_at")}
    kinds = FIELDS | dict.fromkeys(times, at.simpleString())
    folded = changes.mapInArrow(unpacked(schema), ", ".join([f"alert_id {kind}", *[f"{c} {k}" for c, k in kinds.items()]])).withColumns(times)
    table = f"alert_id {kind}, {FOLD}, bucket int"

    def put_aside(rows: DataFrame, aside: str, token: str) -> None:
        rows.withColumn("batch", F.lit(token)).write.mode("overwrite").parquet(aside)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        token = f"{checkpoint}#{batch_id}"
        aside = f"{path}/aside/slot={batch_id % 2}"
        mine = existing(spark, aside, f"{table}, batch string") if finished(spark, aside) else None
        if mine is None or mine.filter(F.col("batch") == token).isEmpty():
            changed = batch.withColumn("bucket", F.pmod(F.xxhash64("alert_id"), F.lit(buckets)).cast("int"))
            kept = existing(spark, f"{path}/current", table)
            if kept is None:  # a batch has one fold per alert
                put_aside(changed, aside, token)
            else:
                changed = changed.persist()
                try:
                    touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]  # `buckets` at most
                    put_aside(merged(changed.unionByName(kept.filter(F.col("bucket").isin(touched)))), aside, token)
                finally:
                    changed.unpersist()
            mine = spark.read.schema(f"{table}, batch string").parquet(aside)
        rows = mine.drop("batch").repartition("bucket")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/current")

    before = {key: spark.conf.get(key) for key in SETTINGS}
    try:  # a query keeps the settings it was started with
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        writer = folded.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
        return writer.trigger(availableNow=True).start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def followed_alerts(spark: SparkSession, path: str, alerts: DataFrame, happened_at: str = "timestamp_ntz") -> DataFrame:
    """Current state of every alert, from the table that `follow_alerts` keeps; `happened_at` is the type of the actions' times."""
    kind = alerts.schema["id"].dataType.simpleString()
    schema = f"alert_id {kind}, {FOLD}, bucket int"
    kept = existing(spark, f"{path}/current", schema)
    kept = spark.createDataFrame([], schema) if kept is None else kept
    timed = kept.withColumns({c: F.col(c).cast(happened_at) for c in ("ack_at", "resolve_at")})
    started = alerts.select(F.col("id").alias("alert_id"), F.col("status").alias("first_status"))
    state = alert_state(started.join(timed, "alert_id", "left"), F.col("first_status"))
    return state.select("alert_id", "first_status", *ALERT_STATE)
