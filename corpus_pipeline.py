"""Training-data pipeline over the `documents` of a folder: classify, check by rules, deduplicate, mix, encode.

Every stage takes (spark, docs, folder) and all rows its predecessor kept; all but the last return the columns of documents.
Between stages `run` writes Parquet to the shared folder of `spark.checkpoint.dir` and reads it back, so a lost executor or a
failed stage costs no more than that stage.

A null, empty or very long text, a tie, a repeated row, an empty table and extra columns are treated as the operators'
docstrings say. Stages number the rows of the table they are given, which is a written one, so numbers are the same in every job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm import mixing, near_dedup, piece_codec, quality_classifier, quality_rules, scratch
from tallywatch.llm import words as W


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def _small_batches(stage: Callable) -> Callable:
    """`stage` with texts handed to Python in batches of some megabytes, unless the session has a limit of its own.

    Without one a batch is 10,000 texts, however long, of which the executor's JVM and its Python worker each hold copies.
    """

    def with_limit(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, str(BATCH_BYTES))
        return stage(spark, docs, folder)

    return with_limit


def _shielded(stage: Callable) -> Callable:
    """`stage` with columns beyond COLUMNS under names that nothing else has, and their own names in its result."""

    def with_any_columns(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        extra = {c: f"extra_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        made = stage(spark, docs.select(*[F.col(f"`{c}`").alias(extra.get(c, c)) for c in docs.columns]), folder)
        return made.select(*[F.col(extra.get(c, c)).alias(c) for c in docs.columns])

    return with_any_columns


def classify(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier, learned from the folder's labels, predicts to be good."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return quality_classifier.predict(docs, quality_classifier.fit(docs, labels), docs.columns, only_kept=True)


def check_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base rules and lie near a language reference of the documents given."""
    return quality_rules.judge(docs, quality_rules.references(docs), only_kept=True)


def deduplicate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest doc_id (none counts last), then the first of the table.

    Rows are compared, not ids: rows that share an id and hold different texts stay, copies go whatever their ids are. What goes
    is found on row numbers and ids alone, so the texts meet it in one join.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    by_row = numbered.select(F.col("_row").alias("doc_id"), "text")
    groups = near_dedup.near_duplicates(by_row, near_dedup.Params(width=5)).select(F.col("doc_id").alias("_row"), "component_id")
    most = docs.count()
    narrow = scratch.cut(scratch.packed(groups.join(numbered.select("_row", "doc_id"), "_row"), most, near_dedup.ROWS_A_PART))
    first = narrow.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first"))
    gone = narrow.join(first.select("first._row"), "_row", "left_anti").select("_row")
    gone = scratch.cut(scratch.packed(gone, most, near_dedup.ROWS_A_PART))
    return numbered.join(gone, "_row", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The words that the mix takes: for each pass a document with its words of that pass, `n_chars` counted anew.

    Words that follow each other keep what stands between them; places where words are left out become a space.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    mixed = mixing.mix(numbered, row="_row")
    places = mixed.positions.filter("size > 0").select("src", "start", "row")  # empty texts share their place
    used = mixed.pieces().groupBy("src", "start", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "n"))).alias("_spans"))
    spans = used.join(places, ["src", "start"]).select(F.col("row").alias("_row"), "pass", "_spans")
    joined = numbered.join(spans, "_row")
    columns = docs.columns

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = batch.column("_spans").to_pylist()
            texts: list[str] = []
            for run in W.runs(batch.column("text")):
                start, end, row = run.words()
                first = np.searchsorted(row, np.arange(run.n))
                raw = run.data.tobytes()
                for i in range(run.n):
                    parts: list[list[int]] = []
                    for span in taken[run.rows.start + i]:
                        if parts and parts[-1][1] == span["first"]:
                            parts[-1][1] += span["n"]
                        else:
                            parts.append([span["first"], span["first"] + span["n"]])
                    cuts = [raw[start[first[i] + a] : end[first[i] + b - 1]] for a, b in parts]
                    texts.append(b" ".join(cuts).decode("utf-8", "replace"))
            arrays = [batch.column(c) for c in columns]
            arrays[columns.index("text")] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    made = joined.select(*[F.col(f"`{c}`") for c in columns], "_spans").mapInArrow(take, T.StructType([docs.schema[c] for c in columns]))
    return made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else made


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The ids of every text: (doc_id, source, n_tokens, ids)."""
    encoded = piece_codec.encode(docs, ["doc_id", "source"])
    return encoded.select("doc_id", "source", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", _small_batches(_shielded(classify))),
    ("quality rules", _small_batches(_shielded(check_rules))),
    ("near-duplicates", _small_batches(_shielded(deduplicate))),
    ("mixing", _small_batches(_shielded(mix_sources))),
    ("encoding", _small_batches(encode)),
]
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, folder)
        path = scratch.folder(spark, name.replace(" ", "-"))
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
