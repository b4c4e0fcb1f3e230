"""Mixing sources to target weights by packed blocks.

A source's texts, in doc_id order, are one stream of words packed into blocks of `block_words` (the last may be shorter).
Every output shard has `shard_slots` slots; how many go to each source is drawn for the shard: the whole part of each
source's expected number, and a multinomial draw over the fractions for the slots left. Totals are then brought to each
source's quota: surplus slots fall away, missing ones form a closing shard. A source's slots are numbered across shards;
slot j of a source with n blocks is pass j div n, and takes block p(j mod n) of a pseudorandom permutation p of that source
and pass. Slots and blocks are joined by source and block number.

Targets: source number i (by code point, NULL last) weighs weights[i mod len(weights)]; together they get `share` times all
words; none gets more than `max_passes` times its own size, and what is above goes to the others by weight, until none is
above. So no block, and no text, is used more than `max_passes` times.

The driver holds one number per source, and refuses more than MAX_SOURCES of them. Running totals are kept per source and
range of doc_ids, so one source may hold most of the rows.

Defined cases: a NULL or empty text has size 0, and nothing of it is taken; NULL is a source like others; rows without a
doc_id come first in the stream; repeated rows each have a place of their own; an empty table gives an empty mix. Other
columns of the input are ignored. Reruns give the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.functions.ordered import bucket_of, running_totals, value_bounds
from tallywatch.llm import words as W
from tallywatch.llm.scratch import cut

MAX_SOURCES = 1 << 20


@dataclass(frozen=True)
class Params:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    max_passes: int = 2
    block_words: int = 64
    shard_slots: int = 1024
    seed: int = 7


@dataclass(frozen=True)
class Mix:
    """positions: (row, doc_id, source, src, size, source_size, target, start); slots: (shard, slot, src, pass, block)."""

    positions: DataFrame
    slots: DataFrame
    params: Params

    def pieces(self) -> DataFrame:
        """The mix itself: every slot with the words it takes (shard, slot, pass, src, start, first, n).

        `start` names the text by its place in its source's stream; `first` counts from the text's first word.
        """
        size = self.params.block_words
        spans = self.positions.filter("size > 0").select(
            "src",
            "start",
            "size",
            F.explode(F.sequence(F.expr(f"start div {size}"), F.expr(f"(start + size - 1) div {size}"))).alias("block"),
        )
        low = F.greatest(F.col("start"), F.col("block") * size)
        high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * size)
        cut_up = spans.select("src", "block", "start", (low - F.col("start")).alias("first"), (high - low).alias("n"))
        return self.slots.join(cut_up, ["src", "block"])


def sized(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Number of words of every row: (row, doc_id, source, size); the column `row`, if named, numbers the rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.bincount(run.words()[2], minlength=run.n) for run in W.runs(batch.column("text"))]
            size = pa.array(np.concatenate([*n, np.zeros(0, dtype=np.int64)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "source")), size], names=["row", "doc_id", "source", "size"])

    narrow = docs.select(
        (F.lit(0) if row is None else F.col(row)).cast("long").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(count, "row long, doc_id long, source string, size long")


def _sources(sizes: DataFrame, params: Params) -> DataFrame:
    """Every source with its number by code point and its target: (source, src, source_size, target)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = totals.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id())
    ranged = cut(ranged)
    counts = sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, offsets = 0, [F.lit(-1), F.lit(0)]
    for part, n in counts:
        offsets += [F.lit(part), F.lit(before)]
        before += n
    if before > MAX_SOURCES:
        raise ValueError(f"{before} sources; a mix takes at most {MAX_SOURCES}")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1
    numbered = ranged.withColumn("src", (F.create_map(*offsets)[F.col("part")] + inside).cast("long"))
    weights = F.array(*[F.lit(float(w)) for w in params.weights])
    weighed = cut(
        numbered.withColumn("weight", F.get(weights, (F.col("src") % len(params.weights)).cast("int")))
        .withColumn("most", F.col("source_size") * float(params.max_passes))
        .drop("part")
    )
    level, goal = 0.0, params.share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    while True:  # words per weight; it only grows, as each round takes more sources to their most
        full = F.col("most") <= F.col("weight") * level
        found = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        new = (goal - found["given"]) / found["weight"] if found["weight"] else level
        if new <= level:
            break
        level = new
    return weighed.select(
        "source", "src", "source_size", F.least("most", F.col("weight") * level).alias("target")
    )


def _permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Places of `index` in a pseudorandom permutation of 0..n-1: a Feistel network walked until it falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = W.mix(np.uint64(key) + np.arange(1, 5, dtype=np.uint64))
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (W.mix(right ^ k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _draws(spark, quota: np.ndarray, params: Params) -> DataFrame:
    """Slots of every source in every shard: (shard, src, n)."""
    total = int(quota.sum())
    shards = -(-total // params.shard_slots)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                slots = min(params.shard_slots, total - shard * params.shard_slots)
                expected = slots * quota / total
                counts = np.floor(expected).astype(np.int64)
                left = expected - counts
                rest = slots - int(counts.sum())
                if rest > 0:
                    counts += np.random.default_rng([params.seed, shard]).multinomial(rest, left / left.sum())
                src = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(src), shard)), pa.array(src), pa.array(counts[src])], names=["shard", "src", "n"]
                )

    return spark.range(shards).mapInArrow(draw, "shard long, src long, n long")


def mix(docs: DataFrame, params: Params = Params(), row: str | None = None) -> Mix:
    """The mix of `docs` (doc_id, source, text); the column `row`, if named, is carried to the positions."""
    spark, size = docs.sparkSession, params.block_words
    sizes = cut(sized(docs, row))
    sources = _sources(sizes, params)
    table = sources.select("src", "source_size", "target").toPandas().sort_values("src")
    blocks = -(-table["source_size"].to_numpy(dtype=np.int64) // size)
    per_block = table["source_size"].to_numpy() / np.maximum(blocks, 1)
    quota = np.rint(table["target"].to_numpy() / np.maximum(per_block, 1)).astype(np.int64)
    quota = np.minimum(quota, params.max_passes * blocks)

    keyed = sizes.withColumn("_k", F.struct("source")).join(sources.withColumn("_k", F.struct("source")).drop("source"), "_k").drop("_k")
    pieces = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = value_bounds(sizes, ["doc_id"], pieces)["doc_id"] if len(table) else []
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("row")]
    ended = running_totals(keyed.withColumn("end", F.col("size")), ["src"], order, ["end"], bucket_of(F.col("doc_id"), bounds))
    positions = cut(ended.withColumn("start", F.col("end") - F.col("size")).drop("end"))

    draws = cut(_draws(spark, quota, params)) if quota.sum() else spark.createDataFrame([], "shard long, src long, n long")
    numbered = running_totals(draws.withColumn("last", F.col("n")), ["src"], [F.col("shard")], ["last"], F.expr("shard div 4096"))
    numbered = numbered.withColumn("first", F.col("last") - F.col("n")).drop("last")
    drawn = {r["src"]: r["n"] for r in draws.groupBy("src").agg(F.sum("n").alias("n")).collect()}
    closing = -(-int(quota.sum()) // params.shard_slots)
    missing = [(closing, int(s), int(q - drawn.get(s, 0)), int(drawn.get(s, 0))) for s, q in enumerate(quota) if q > drawn.get(s, 0)]
    numbered = numbered.select("shard", "src", "n", "first").union(spark.createDataFrame(missing, "shard long, src long, n long, first long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("shard", "src", "n", "first")]
            for shard, src, n, first in zip(*columns):
                for low in range(first, min(first + n, quota[src]), 1 << 16):
                    high = min(low + (1 << 16), first + n, quota[src])
                    ordinal = np.arange(low, high)
                    passes, index = ordinal // blocks[src], ordinal % blocks[src]
                    block = np.empty_like(index)
                    for p in np.unique(passes):
                        own = passes == p
                        block[own] = _permuted(index[own], int(blocks[src]), (params.seed << 40) ^ (int(src) << 8) ^ int(p))
                    width = len(ordinal)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (np.full(width, shard), ordinal - first, np.full(width, src), passes, block)],
                        names=["shard", "slot", "src", "pass", "block"],
                    )

    # a row stands for up to a shard of slots: dealt out anew, as the few rows would else share a task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = numbered.repartition(tasks, "src", "shard").mapInArrow(place, "shard long, slot long, src long, pass long, block long")
    return Mix(positions, slots, params)


def taken(mixed: Mix) -> DataFrame:
    """Words the mix takes of every row: (doc_id, size, source_size, target, taken)."""
    used = mixed.pieces().groupBy("src", "start").agg(F.sum("n").alias("taken"))
    empty = mixed.positions.filter("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    full = mixed.positions.filter("size > 0").join(used, ["src", "start"], "left")
    return full.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")).union(empty)
