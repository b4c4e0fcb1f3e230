"""Ranked lexical search by hashed max-sketches.

A term's impact in a document depends on its frequency and the document's length alone, so a document can be summarised
before any query is known: its terms are hashed to slots and each slot keeps the largest impact of its terms (coordinatewise
maxima). For an item, the weighted slots of its terms add up to an upper bound of the document's score. Bounds of a block of
documents are looked up for a whole batch of items; each item's documents are then scored exactly in descending order of
their bounds until the next bound is below the item's threshold, the score of the k-th best document its task has seen.
The best of all tasks are merged by rank. Every document meets every item through its bound, so the result is exact.

Two passes over the texts: one counts documents, terms and the document frequencies of the batch's terms (partial sums per
task, combined before the shuffle), the other bounds and scores. No text is shuffled. A sketch has `slots_per_term` slots for
each distinct term (a power of two), so long documents get as tight bounds as short ones. Items are taken in batches of at
most `items_a_batch` rows; only a batch's term hashes and weights go to the tasks and only its frequencies come back. Terms
are told apart by 64-bit hashes.

Defined cases: a NULL or empty text has no terms, counts for nothing and is never found; an item without terms finds nothing;
equal scores are ordered by doc_id, rows without one last; rows that repeat a doc_id are documents of their own, rows that
repeat an item_id items of their own (with ranks of their own); ids are cast to long; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm import words as W
from tallywatch.llm.scratch import cut

_ROW = np.uint64(0xD6E8FEB86659FD93)
RESULT = "item_id long, rank int, doc_id long, score long"


@dataclass(frozen=True)
class Params:
    k: int = 10
    slots_per_term: int = 4
    items_a_batch: int = 4096
    chunk: int = 64  # documents scored between two looks at the threshold


@dataclass(frozen=True)
class Statistics:
    documents: int
    terms: int
    frequencies: np.ndarray  # of the batch's terms

    def weights(self) -> np.ndarray:
        n = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(n / (2 * int(df) + 1))) for df in self.frequencies], dtype=np.int64)


@dataclass(frozen=True)
class Items:
    """A batch of items: their ids, and the places of each one's distinct terms in the batch's sorted vocabulary."""

    ids: list[int | None]
    vocabulary: np.ndarray
    terms: list[np.ndarray]


def items_of(ids: pa.Array, texts: pa.Array) -> Items:
    per_item: list[np.ndarray] = []
    for run in W.runs(texts):
        hashes, row = run.terms()
        cuts = np.searchsorted(row, np.arange(run.n + 1))
        per_item += [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    vocabulary = np.unique(np.concatenate(per_item)) if per_item else np.zeros(0, dtype=np.uint64)
    return Items(ids.to_pylist(), vocabulary, [np.searchsorted(vocabulary, t) for t in per_item])


def batches(items: DataFrame, size: int) -> Iterator[pa.Table]:
    """The rows of (item_id, text) in tables of at most `size` rows; the driver holds one at a time."""
    row = F.monotonically_increasing_id()
    numbered = cut(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), row.alias("row")))
    number = F.col("row") - F.col("row") % size  # a task's rows are numbered without gaps from a multiple of 2 ** 33
    for found in numbered.groupBy(number.alias("b")).count().orderBy("b").collect():
        yield numbered.filter((F.col("row") >= found["b"]) & (F.col("row") < found["b"] + size)).orderBy("row").toArrow()


def _known(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return place, vocabulary[place] == hashes


def statistics(docs: DataFrame, vocabulary: np.ndarray) -> Statistics:
    """Number of documents with a term, of all terms, and document frequencies of the sorted term hashes in `vocabulary`."""
    size = len(vocabulary)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + 2, dtype=np.int64)
        for batch in parts:
            for run in W.runs(batch.column("text")):
                hashes, row = run.terms()
                sums[size] += len(np.unique(row))
                sums[size + 1] += len(hashes)
                if size:
                    place, known = _known(vocabulary, hashes)
                    pairs = np.unique(row[known] * size + place[known])
                    sums[:size] += np.bincount(pairs % size, minlength=size)
        place = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums[place])], names=["place", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "place long, n long")
    sums = np.zeros(size + 2, dtype=np.int64)
    for found in counted.groupBy("place").agg(F.sum("n").alias("n")).collect():  # as many rows as the batch has terms
        sums[found["place"]] = found["n"]
    return Statistics(int(sums[size]), int(sums[size + 1]), sums[:size])


class Sketches:
    """Impacts and max-sketches of the documents of a run of texts."""

    def __init__(self, run: W.Run, documents: int, terms: int, slots_per_term: int):
        hashes, row = run.terms()
        length = np.bincount(row, minlength=run.n)
        keys, first, tf = np.unique(self._keys(row, hashes), return_index=True, return_counts=True)
        self.keys, row, hashes = keys, row[first], hashes[first]
        m = 10 + (90 * length * documents) // max(terms, 1)
        self.impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
        distinct = np.bincount(row, minlength=run.n)
        bits = np.ceil(np.log2(np.maximum(distinct * slots_per_term, 1))).astype(np.uint64)
        self.mask = (np.uint64(1) << bits) - np.uint64(1)
        ends = np.cumsum(self.mask.astype(np.int64) + 1)
        self.base = ends - self.mask.astype(np.int64) - 1
        self.slots = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        np.maximum.at(self.slots, self.base[row] + (hashes & self.mask[row]).astype(np.int64), self.impacts)

    @staticmethod
    def _keys(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return W.mix(hashes ^ (row.astype(np.uint64) + np.uint64(1)) * _ROW)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """An upper bound of every document's score."""
        out = np.zeros(len(self.base), dtype=np.int64)
        for term, weight in zip(terms, weights):
            out += weight * self.slots[self.base + (term & self.mask).astype(np.int64)]
        return out

    def scores(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The exact scores of some documents."""
        place, known = _known(self.keys, self._keys(rows[:, None], terms[None, :]))
        return np.where(known, self.impacts[place], 0) @ weights


class Best:
    """The best k (score, doc_id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.ids, self.missing = k, *(np.zeros(0, dtype=t) for t in (np.int64, np.int64, bool))

    @property
    def threshold(self) -> int:
        """Documents with a lower score are not among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        score, ids, missing = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort((ids, missing, -score))
        order = order[score[order] > 0][: self.k]
        self.score, self.ids, self.missing = score[order], ids[order], missing[order]


def search_run(sketches: Sketches, ids: np.ndarray, missing: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: Best, chunk: int) -> int:
    """Add the documents of a run to the best of an item; how many were scored exactly."""
    bounds = sketches.bounds(terms, weights)
    open_ = np.flatnonzero(bounds >= best.threshold)
    open_ = open_[np.argsort(-bounds[open_], kind="stable")]
    at = 0
    while at < len(open_) and bounds[open_[at]] >= best.threshold:
        rows = open_[at : at + chunk]
        rows = rows[bounds[rows] >= best.threshold]
        best.add(sketches.scores(rows, terms, weights), ids[rows], missing[rows])
        at += chunk
    return min(at, len(open_))


def _search(docs: DataFrame, items: Items, params: Params, number: int) -> DataFrame:
    found = statistics(docs, items.vocabulary)
    weights, n_docs, n_terms = found.weights(), found.documents, found.terms
    hashes, places, ids = items.vocabulary, items.terms, items.ids

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(params.k) for _ in places]
        asked = [(hashes[t], weights[t], b) for t, b in zip(places, best) if len(t)]
        for batch in parts:
            names = batch.column("doc_id")
            missing, names = np.asarray(names.is_null()), np.asarray(names.fill_null(0))
            for run in W.runs(batch.column("text")):
                if len(run.data):
                    sketches = Sketches(run, n_docs, n_terms, params.slots_per_term)
                    if len(sketches.keys):
                        for terms, weight, kept in asked:
                            search_run(sketches, names[run.rows], missing[run.rows], terms, weight, kept, params.chunk)
        n = [len(b.score) for b in best]
        columns = [
            pa.array(np.repeat(np.arange(len(best)), n)),
            pa.array([i for i, k in zip(ids, n) for _ in range(k)], pa.int64()),
            pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.missing for b in best])),
            pa.array(np.concatenate([b.score for b in best])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = narrow.mapInArrow(search, "item long, item_id long, doc_id long, score long")
    return made.withColumn("batch", F.lit(number))


def rank(items: DataFrame, docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The k highest-scoring documents of every item: (item_id, rank, doc_id, score)."""
    made = []
    for number, table in enumerate(batches(items, params.items_a_batch)):
        batch = items_of(table.column("item_id").combine_chunks(), table.column("text"))
        if len(batch.vocabulary):
            made.append(_search(docs, batch, params, number))
    if not made:
        return docs.sparkSession.createDataFrame([], RESULT)
    order = Window.partitionBy("batch", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.union, made).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= params.k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH terms AS (SELECT row_number() OVER () AS r, doc_id,
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents),
  docs AS (SELECT r, doc_id, t, len(t) AS n FROM terms WHERE len(t) > 0),
  totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
  postings AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM docs) GROUP BY ALL),
  wanted AS (SELECT DISTINCT i, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS i, item_id,
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM benchmark)),
  weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
  scores AS (SELECT i, item_id, r, doc_id,
      CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS "rank", doc_id, score
FROM scores WHERE score > 0 QUALIFY "rank" <= 10"""
