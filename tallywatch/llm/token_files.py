"""Token ids on disk, compressed by Re-Pair grammars.

Texts are dealt out by ranges of doc_id, so the files hold them in ascending order. A task encodes its texts with the
tokenizers library and writes shards of about `shard_ids` ids, cut between texts. In each shard frequent pairs of ids are
replaced by new symbols again and again, many pairs a round, until too few pairs repeat; a shard keeps its rules (left and
right symbol), the length every rule expands to, the last sequence, and where each text begins. With the lengths summed up
any stretch of ids is found and expanded without the rest (`Shard.read`).

The file format is a Parquet table of shards, one row each, because only Spark's writers reach the shared storage of a
cluster: `part` and `shard` give the order, `rules`, `sequence` and `lengths` are little-endian 32-bit numbers.

Encoding works on units: a text is cut before single spaces, around other single white space, and between a letter and
punctuation (A-Z and ASCII), where the tokenizer cuts in any case. The distinct units of some megabytes of text are encoded
at once, and their ids are kept for the next time they come (`kept_units`). Texts with two white-space characters in a row
or special tokens are encoded whole.

Defined cases: a NULL or empty text has only the end id; rows without a doc_id come first; repeated rows are written each
for itself, next to each other; an empty table gives no shards. Other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm import words as W


@dataclass(frozen=True)
class Params:
    tokenizer: str = "byte_bpe_50k.json"
    end_id: int = 0
    shard_ids: int = 1 << 18
    rounds: int = 6
    pairs_a_round: int = 2048
    least_count: int = 12
    kept_units: int = 2_000_000
    run_bytes: int = 8 << 20


SHARDS = "part long, shard long, before long, n long, docs array<struct<doc_id: long, n: long>>, rules binary, lengths binary, sequence binary"


# --- encoding -------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _tokenizer(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))


def _before_spaces() -> np.ndarray:
    """Bytes of ASCII letters (1) and of ASCII punctuation (2)."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
    kind[[*range(65, 91), *range(97, 123)]] = 1
    return kind


_KIND = _before_spaces()


class Encoder:
    """Ids of texts, from the ids of their distinct units."""

    def __init__(self, params: Params):
        self.params = params
        self.tokenizer = _tokenizer(params.tokenizer)
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special)) or rb"(?!)")
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted hashes of known units
        self.begin, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)  # where their ids are
        self.ids = np.zeros(0, dtype=np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, run: W.Run) -> np.ndarray:
        """Rows to be encoded whole: white space touches white space, or a special token is there."""
        data = run.data
        ends = np.zeros(len(data) + 3, dtype=np.uint8)
        ends[: len(data)] = data
        one, two, three = ends[: len(data)], ends[1 : len(data) + 1], ends[2 : len(data) + 2]
        inside = np.ones(len(data), dtype=bool)
        inside[run.offsets[1:][run.offsets[1:] > 0] - 1] = False  # last bytes of rows
        odd = W.SPACE[one] & W.SPACE[two] & inside
        # white space beyond ASCII
        odd |= (one >= 28) & (one <= 31) | (one == 0xC2) & ((two == 0x85) | (two == 0xA0)) | (one == 0xE1) & (two == 0x9A)
        odd |= (one == 0xE2) & ((two == 0x81) & (three == 0x9F) | (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)))
        odd |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
        out = run.per_row(odd) > 0
        for found in self.special.finditer(data.tobytes()):
            out[np.searchsorted(run.offsets, found.start(), "right") - 1] = True
        return out

    def _learn(self, units: list[str], keys: np.ndarray) -> None:
        """Add units with their hashes."""
        found = self._ids(units)
        count = np.array([len(i) for i in found], dtype=np.int64)
        ids = np.fromiter((x for i in found for x in i), dtype=np.uint32, count=int(count.sum()))
        begin = len(self.ids) + np.cumsum(count) - count
        order = np.argsort(every := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = every[order]
        self.begin, self.count = np.concatenate([self.begin, begin])[order], np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, run: W.Run) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a run one after the other, each with its end id, and how many each row has."""
        data, whole = run.data, self._whole(run)
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[run.offsets] = True
        space, kind = W.SPACE[data], _KIND[data]
        edge[:-1] |= space
        edge[1:] |= space & (data != 32)
        edge[1:-1] |= (kind[:-1] == 1) & (kind[1:] == 2)
        start = np.flatnonzero(edge[:-1])
        end = np.append(start[1:], len(data))
        row = np.searchsorted(run.offsets, start, "right") - 1
        split = ~whole[row]
        start, end, row = start[split], end[split], row[split]
        keys, first, unit = np.unique(W.span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.params.kept_units:
            self._forget()
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[place] == keys
        raw = data.tobytes()
        new = np.flatnonzero(~known)
        self._learn([raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]], end[first[new]])], keys[new])
        place = np.searchsorted(self.keys, keys)[unit]

        # every row is a list of parts: its units, or its own ids, and the end id
        n_end = np.flatnonzero(whole)
        own = self._ids([raw[run.offsets[i] : run.offsets[i + 1]].decode("utf-8", "replace") for i in n_end])
        table = np.concatenate([self.ids, [self.params.end_id], *own]).astype(np.uint32)
        sizes = np.array([len(i) for i in own], dtype=np.int64)
        rows = np.arange(run.n)
        part_row = np.concatenate([row, n_end, rows])
        order = np.argsort(part_row, kind="stable")
        begin = np.concatenate([self.begin[place], len(self.ids) + 1 + np.cumsum(sizes) - sizes, np.full(run.n, len(self.ids))])[order]
        count = np.concatenate([self.count[place], sizes, np.ones(run.n, dtype=np.int64)])[order]
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return table[at], np.bincount(part_row[order], count, minlength=run.n).astype(np.int64)


@lru_cache(maxsize=1)
def _encoder(params: Params) -> Encoder:
    """The encoder of this process: units stay known from task to task."""
    return Encoder(params)


# --- Re-Pair --------------------------------------------------------------------------------------------------------


_HASH = np.uint64(0x9E3779B97F4A7C15)


def _disjoint(at: np.ndarray) -> np.ndarray:
    """Which of the ascending positions of pairs are replaced: every other one in runs that touch."""
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = np.diff(at) != 1
    first = np.maximum.accumulate(np.where(opens, at, 0))
    return (at - first) % 2 == 0


def compress(ids: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (rows of two symbols), the lengths they expand to, and the last sequence.

    Symbols below the number of plain ids (`2 ** 24`) are ids, symbol 2 ** 24 + r is rule r.
    """
    sequence = ids.astype(np.uint32)
    rules, lengths = [np.zeros((0, 2), dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
    made = 0
    for _ in range(params.rounds):
        if len(sequence) < 2:
            break
        pairs = (sequence[:-1].astype(np.uint64) << np.uint64(32)) | sequence[1:]
        order = np.sort(pairs)
        edge = np.flatnonzero(np.append(True, order[1:] != order[:-1]))
        counts = np.diff(np.append(edge, len(order)))
        often = np.flatnonzero(counts >= params.least_count)
        if not len(often):
            break
        if len(often) > params.pairs_a_round:
            often = often[np.argpartition(-counts[often], params.pairs_a_round)[: params.pairs_a_round]]
        keys = np.sort(order[edge[often]])
        maybe = np.zeros(1 << 16, dtype=bool)  # most pairs are seen not to be among the keys by a hash of 16 bits
        maybe[keys * _HASH >> np.uint64(48)] = True
        near = np.flatnonzero(maybe[pairs * _HASH >> np.uint64(48)])
        place = np.minimum(np.searchsorted(keys, pairs[near]), len(keys) - 1)
        equal = keys[place] == pairs[near]
        near, place = near[equal], place[equal]
        kept = _disjoint(near)
        at, place = near[kept], place[kept]
        new = np.stack([keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        sequence = sequence.copy()
        sequence[at] = (1 << 24) + made + place
        gone = np.zeros(len(sequence), dtype=bool)
        gone[at + 1] = True
        sequence = sequence[~gone]
        known = np.concatenate(lengths)
        size = np.where(new < 1 << 24, 1, known[np.maximum(new.astype(np.int64) - (1 << 24), 0)] if len(known) else 1)
        rules.append(new)
        lengths.append(size.sum(axis=1))
        made += len(keys)
    return np.concatenate(rules), np.concatenate(lengths), sequence


def _expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    while len(rules) and len(at := np.flatnonzero(symbols >= 1 << 24)):
        width = np.ones(len(symbols), dtype=np.int64)
        width[at] = 2
        begin = np.cumsum(width) - width
        out = np.empty(int(width.sum()), dtype=np.uint32)
        out[begin] = symbols
        both = rules[symbols[at] - (1 << 24)]
        out[begin[at]], out[begin[at] + 1] = both[:, 0], both[:, 1]
        symbols = out
    return symbols


class Shard:
    """One shard as read from its file."""

    def __init__(self, rules: bytes, lengths: bytes, sequence: bytes):
        self.rules = np.frombuffer(rules, dtype="<u4").reshape(-1, 2)
        self.sequence = np.frombuffer(sequence, dtype="<u4")
        size = np.frombuffer(lengths, dtype="<u4").astype(np.int64)
        one = self.sequence < 1 << 24
        own = np.where(one, 1, size[np.where(one, 0, self.sequence.astype(np.int64) - (1 << 24))] if len(size) else 1)
        self.ends = np.cumsum(own)

    def read(self, low: int, high: int) -> np.ndarray:
        """Ids number `low` up to `high`, expanded from the symbols that cover them alone."""
        first = int(np.searchsorted(self.ends, low, "right"))
        last = int(np.searchsorted(self.ends, high, "left")) + 1
        before = int(self.ends[first - 1]) if first else 0
        return _expand(self.sequence[first:last], self.rules)[low - before : high - before]


# --- files ----------------------------------------------------------------------------------------------------------


def shards(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The shards of all texts, in the order of doc_id by (part, shard)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard, before, held = _encoder(params), None, 0, 0, 0
        names: list = []  # of the texts that wait for the shard to fill
        counts: list[int] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            rules, lengths, sequence = compress(np.concatenate(ids), params)
            texts = [{"doc_id": d, "n": n} for d, n in zip(names, counts)]
            raw = [x.astype("<u4").tobytes() for x in (rules, lengths, sequence)]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64())]))] + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip([part, shard, before, held, texts, *raw], kinds)],
                names=["part", "shard", "before", "n", "docs", "rules", "lengths", "sequence"],
            )

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for run in W.runs(batch.column("text"), params.run_bytes):
                found, n = encoder.encode(run)
                ends = np.cumsum(n)
                for doc_id, low, high in zip(batch.column("doc_id")[run.rows].to_pylist(), (ends - n).tolist(), ends.tolist()):
                    if counts and held + high - low > params.shard_ids:
                        yield flush()
                        before, shard, held = before + held, shard + 1, 0
                        names, counts, ids = [], [], []
                    held += high - low
                    names.append(doc_id)
                    counts.append(high - low)
                    ids.append(found[low:high])
        if counts:
            yield flush()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = narrow.repartitionByRange(tasks, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return ranged.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(pack, SHARDS)


def write(docs: DataFrame, path: str, params: Params = Params()) -> None:
    """Write the files of all texts to a folder that every executor reaches."""
    shards(docs, params).write.parquet(path)


def read_back(files: DataFrame) -> DataFrame:
    """Every text's ids from its files: (doc_id, start, n_tokens, ids_crc32)."""
    totals = files.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per writing task, as many as the shuffle had partitions
    starts = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_start"))
    placed = files.join(F.broadcast(starts), "part").withColumn("shard_start", F.col("part_start") + F.col("before"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["rules"], row["lengths"], row["sequence"])
                n = np.array([d["n"] for d in row["docs"]], dtype=np.int64)
                ends = np.cumsum(n)
                sums = [zlib.crc32(shard.read(e - k, e).astype("<u4").tobytes()) for k, e in zip(n.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d["doc_id"] for d in row["docs"]], pa.int64()),
                        pa.array(row["shard_start"] + ends - n),
                        pa.array(n),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.select("docs", "rules", "lengths", "sequence", "shard_start").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
