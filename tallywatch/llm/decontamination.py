"""Benchmark decontamination with a distributed positional inverted index.

`build` cuts the documents into shards of some megabytes of text and stores for each a positional inverted index: the sorted
term hashes and, for each term, the ascending positions of its tokens in the shard. Shards are rows of Parquet files; each is
made where its texts are read, so no token is shuffled. `phrases` takes every window of `width` consecutive item words (an
item of fewer words is one window) and finds its occurrences: the shard's shortest posting list among the window's terms
gives candidate places, and the other lists are intersected with them, each moved by its term's offset, from the rarest to
the commonest. `near` finds proximity matches likewise: all words of a window, repeats counted, within `span` consecutive
words of one document in any order. Both look at every document and give exact answers (terms are told apart by 64-bit hashes).

Terms are lower-cased (A-Z) runs of ASCII letters, digits and characters beyond ASCII. Items are taken in batches of at most
`items_a_batch` rows, whose windows go to the tasks; the spans that several batches hit in a document are united.

Defined cases: a NULL or empty text has no words and is never hit; an item without words has no window; a window of repeated
words is found where the words repeat; items that repeat an item_id or a text are found together, an item without an id hits
but is not counted; rows that repeat a doc_id or have none are documents of their own; ids are cast to long; an empty table of
documents gives an empty result, an empty table of items leaves all documents clean. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallywatch.llm import scratch
from tallywatch.llm import words as W
from tallywatch.llm.lexical_search import batches

INDEX = "shard long, doc_ids array<long>, n_words array<long>, terms binary, counts binary, steps binary"
SPANS = "row long, spans array<struct<start:long,stop:long>>, items array<long>"
NEAR = "row long, doc_id long, item_id long, start long"
CANDIDATES = 1 << 21  # places looked at together


@dataclass(frozen=True)
class Params:
    width: int = 10
    run_bytes: int = W.RUN_BYTES
    items_a_batch: int = 4096
    span: int = 20  # of proximity matches


# --- index ------------------------------------------------------------------------------------------------------------


def index(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row for each shard; a row of documents is known by `shard * 2 ** 32 + its place in the shard`."""

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 20
        for batch in parts:
            for run in W.runs(batch.column("text"), params.run_bytes):
                hashes, row = run.terms()
                order = np.argsort(hashes, kind="stable").astype(np.uint32)
                ordered = hashes[order]
                first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, dtype=np.int64)
                counts = np.diff(np.append(first, len(ordered)))
                steps = np.diff(order, prepend=np.uint32(0))
                steps[first] = order[first]
                raw = [ordered[first].astype("<u8"), counts.astype("<u4"), steps.astype("<u4")]
                sizes = np.bincount(row, minlength=run.n)
                columns = [pa.array([shard]), pa.array([batch.column("doc_id")[run.rows].to_pylist()], pa.list_(pa.int64())), pa.array([sizes])]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array([x.tobytes()], pa.binary()) for x in raw],
                    names=["shard", "doc_ids", "n_words", "terms", "counts", "steps"],
                )
                shard += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, INDEX)


def build(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The index, written to the shared folder and read back."""
    spark, path = docs.sparkSession, scratch.folder(docs.sparkSession, "positions")
    index(docs, params).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


class Shard:
    """A shard's posting lists."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], dtype="<u8")
        self.counts = np.frombuffer(row["counts"], dtype="<u4").astype(np.int64)
        steps = np.frombuffer(row["steps"], dtype="<u4").astype(np.int64)
        ends = np.cumsum(self.counts)
        self.first = ends - self.counts
        sums = np.cumsum(steps)
        before = np.append(0, sums)[self.first]
        self.positions = sums - np.repeat(before, self.counts)
        self.size = len(self.positions)
        # (term, position) as one number: ascending, so all lists are searched at once
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * (self.size + 1) + self.positions
        self.row, self.doc_ids = int(row["shard"]) << 32, row["doc_ids"]
        self.ends = np.cumsum(np.asarray(row["n_words"], dtype=np.int64))
        self.starts = self.ends - np.asarray(row["n_words"], dtype=np.int64)

    def doc(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, position, "right")

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * (self.size + 1) + position
        return (position < self.size) & (self.keys[np.minimum(np.searchsorted(self.keys, key), self.size - 1)] == key)

    def within(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many tokens of a term are at positions from low up to high."""
        base = term * (self.size + 1)
        return np.searchsorted(self.keys, base + np.maximum(high, low)) - np.searchsorted(self.keys, base + low)


# --- windows ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a batch of items: term hashes (rows filled with 0), their number, and the items of each."""

    terms: np.ndarray
    length: np.ndarray
    cuts: np.ndarray
    items: np.ndarray
    counted: np.ndarray  # whether the item has an id


def windows_of(ids: pa.Array, texts: pa.Array, width: int) -> Windows:
    known = [np.zeros((0, width + 1), dtype=np.uint64)]
    owner = [np.zeros(0, dtype=np.int64)]
    for run in W.runs(texts):
        hashes, row = run.terms()
        cuts = np.searchsorted(row, np.arange(run.n + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            n = min(width, b - a)
            if n:
                made = np.zeros((b - a - n + 1, width + 1), dtype=np.uint64)
                made[:, :n] = np.lib.stride_tricks.sliding_window_view(hashes[a:b], n)
                made[:, width] = n
                known.append(made)
                owner.append(np.full(len(made), run.rows.start + i))
    distinct, place = np.unique(np.concatenate(known), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([place.reshape(-1), np.concatenate(owner)], axis=1), axis=0)
    items, counted = np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid())
    cuts = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
    return Windows(distinct[:, :width], distinct[:, width].astype(np.int64), cuts, items[pairs[:, 1]], counted[pairs[:, 1]])


class Asked:
    """The windows whose terms all occur in a shard: their number, terms as places in the shard's lists, columns by rarity."""

    def __init__(self, shard: Shard, windows: Windows):
        used = np.arange(windows.terms.shape[1])[None, :] < windows.length[:, None]
        place = np.minimum(np.searchsorted(shard.terms, windows.terms), max(len(shard.terms) - 1, 0))
        met = (shard.terms[place] == windows.terms) | ~used if len(shard.terms) else np.zeros(used.shape, dtype=bool)
        self.window = np.flatnonzero(met.all(axis=1))
        self.place, self.length, self.used = place[self.window], windows.length[self.window], used[self.window]
        counts = np.where(self.used, shard.counts[self.place] if len(shard.counts) else 0, np.iinfo(np.int64).max)
        self.rarity = np.argsort(counts, axis=1, kind="stable")

    def places(self, shard: Shard) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every (place of a window, position of its rarest term), some windows at a time."""
        rarest = np.take_along_axis(self.place, self.rarity[:, :1], axis=1)[:, 0]
        ends = np.cumsum(shard.counts[rarest]) if len(rarest) else np.zeros(0, dtype=np.int64)
        at = 0
        while at < len(rarest):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
            n = shard.counts[rarest[at:stop]]
            asked = np.repeat(np.arange(at, stop), n)
            inside = np.arange(len(asked)) - np.repeat(np.cumsum(n) - n, n)
            yield asked, shard.positions[shard.first[rarest[asked]] + inside]
            at = stop


# --- matches ----------------------------------------------------------------------------------------------------------


def occurrences(shard: Shard, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Every (window, position) where a window occurs within one document of the shard."""
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    asked = Asked(shard, windows)
    for of, position in asked.places(shard):
        start = position - asked.rarity[of, 0]
        of, start = of[start >= 0], start[start >= 0]
        for step in range(1, asked.rarity.shape[1]):
            j = asked.rarity[of, step]
            kept = ~asked.used[of, j] | shard.has(asked.place[of, j], start + j)
            of, start = of[kept], start[kept]
        kept = shard.doc(start) == shard.doc(start + asked.length[of] - 1)
        found.append((asked.window[of[kept]], start[kept]))
    return tuple(np.concatenate(x) for x in zip(*found))


def proximities(shard: Shard, windows: Windows, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of intervals of `span` words of one document, each around a token of the window's rarest term, that
    hold all words of the window; of an interval's places the last one is given for each token."""
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    asked = Asked(shard, windows)
    own = windows.terms[asked.window]
    times = ((own[:, :, None] == own[:, None, :]) & asked.used[:, None, :]).sum(axis=2)
    for of, position in asked.places(shard):
        doc = shard.doc(position)
        first, end = shard.starts[doc], shard.ends[doc]

        def hold(low: np.ndarray, high: np.ndarray, of: np.ndarray, j: np.ndarray) -> np.ndarray:
            return ~asked.used[of, j] | (shard.within(asked.place[of, j], low, high) >= times[of, j])

        for step in range(asked.rarity.shape[1]):
            low, high = np.maximum(position - span + 1, first), np.minimum(position + span, end)
            kept = hold(low, high, of, asked.rarity[of, step])
            of, position, first, end = of[kept], position[kept], first[kept], end[kept]
        for back in range(span):
            low, high = np.maximum(position - back, first), np.minimum(position - back + span, end)
            whole = np.ones(len(of), dtype=bool)
            for j in range(own.shape[1]):
                whole &= hold(low, high, of, np.full(len(of), j))
            found.append((asked.window[of[whole]], low[whole]))
            of, position, first, end = of[~whole], position[~whole], first[~whole], end[~whole]
    return tuple(np.concatenate(x) for x in zip(*found))


def _pairs(shard: Shard, windows: Windows, window: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, index into the windows' items) of matches."""
    n = windows.cuts[window + 1] - windows.cuts[window]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    item = windows.items[np.repeat(windows.cuts[window], n) + inside]
    counted = windows.counted[np.repeat(windows.cuts[window], n) + inside]
    pairs = np.unique(np.stack([np.repeat(shard.doc(position), n), item], axis=1)[counted], axis=0)
    return pairs[:, 0], pairs[:, 1]


def _hits(shard: Shard, windows: Windows) -> list[dict]:
    """The documents that windows hit: their hit spans, counted from the document's first word, and items."""
    window, start = occurrences(shard, windows)
    if not len(window):
        return []
    change = np.zeros(shard.size + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + windows.length[window], -1)
    inside = np.append(False, np.cumsum(change) > 0)
    opens = inside[1:] & (~inside[:-1] | np.isin(np.arange(shard.size + 1), shard.starts))
    low = np.flatnonzero(opens)
    closes = np.append(inside[1:], False)
    closes = closes[:-1] & (~closes[1:] | np.isin(np.arange(1, shard.size + 2), shard.ends))
    high = np.flatnonzero(closes) + 1
    docs, items = _pairs(shard, windows, window, start)
    out = []
    for doc in np.unique(shard.doc(low)).tolist():
        a, b = np.searchsorted(low, [shard.starts[doc], shard.ends[doc]])
        c, d = np.searchsorted(docs, [doc, doc + 1])
        first = int(shard.starts[doc])
        spans = [{"start": x - first, "stop": y - first} for x, y in zip(low[a:b].tolist(), high[a:b].tolist())]
        out.append({"row": shard.row + doc, "spans": spans, "items": items[c:d].tolist()})
    return out


def _near(shard: Shard, windows: Windows, span: int) -> list[dict]:
    window, start = proximities(shard, windows, span)
    out = {}
    for w, at, doc in zip(window.tolist(), start.tolist(), shard.doc(start).tolist()):
        for i in range(windows.cuts[w], windows.cuts[w + 1]):
            key = (doc, int(windows.items[i]) if windows.counted[i] else None)
            out[key] = min(out.get(key, at), at)
    return [{"row": shard.row + d, "doc_id": shard.doc_ids[d], "item_id": i, "start": at - int(shard.starts[d])} for (d, i), at in out.items()]


def _searched(index: DataFrame, items: DataFrame, params: Params, look: Callable[[Shard, Windows], list[dict]], schema: str) -> DataFrame:
    """What `look` finds in every shard for every batch of items."""
    made, kinds = [], to_arrow_schema(index.sparkSession.createDataFrame([], schema).schema)
    for table in batches(items, params.items_a_batch):
        windows = windows_of(table.column("item_id").combine_chunks(), table.column("text"), params.width)

        def search(parts: Iterator[pa.RecordBatch], windows: Windows = windows) -> Iterator[pa.RecordBatch]:
            for batch in parts:
                for i in range(batch.num_rows):  # one shard at a time: a shard is some megabytes
                    if found := look(Shard(batch.slice(i, 1).to_pylist()[0]), windows):
                        yield pa.RecordBatch.from_pylist(found, schema=kinds)

        if len(windows.length):
            made.append(index.mapInArrow(search, schema))
    return reduce(DataFrame.union, made) if made else index.sparkSession.createDataFrame([], schema)


def phrases(index: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents that hold a window of an item: (row, spans of hit words, ids of the items)."""
    return _searched(index, items, params, _hits, SPANS)


def near(index: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents that hold all words of a window of an item within `span` words: (row, doc_id, item_id, start).

    `start` is where the first interval begins that was found, counted in words of the document.
    """
    return _searched(index, items, params, lambda shard, windows: _near(shard, windows, params.span), NEAR)


def verdicts(index: DataFrame, hits: DataFrame) -> DataFrame:
    """Every document with its hit words and items: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    docs = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "doc")).select(
        (F.shiftleft("shard", 32) + F.col("place")).alias("row"), F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").alias("n_words")
    )
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))

    def unite(sofar, span):
        more = F.greatest(span["stop"] - F.greatest(span["start"], sofar["reach"]), F.lit(0).cast("long"))
        return F.struct((sofar["n"] + more).alias("n"), F.greatest(sofar["reach"], span["stop"]).alias("reach"))

    # a row for each batch of items at most, spans of a batch united
    united = hits.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    counted = united.select(
        "row",
        F.aggregate(F.array_sort("spans"), none, unite, lambda x: x["n"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string")))).alias("names"),
    )
    zero = F.lit(0).cast("long")
    return docs.join(counted, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
  b AS (SELECT item_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
  places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
  spots AS (SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
    FROM places, (SELECT DISTINCT size FROM windows) WHERE i + size - 1 <= len(w)),
  found AS (SELECT r, i, size, item_id FROM spots JOIN windows USING (size, phrase)),
  hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r),
  named AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
