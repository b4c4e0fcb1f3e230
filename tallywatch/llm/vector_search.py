"""Exact top-k search by term-at-a-time accumulation.

Components of a vector are terms, their integer weights floor(scale * x). Candidates are indexed in blocks of rows: each term
has a posting list of the rows where its weight is not 0. For every query row of a query block, the weighted postings of its
terms are scattered into a dense score array over the candidate block, from which the k best are selected by partition
(ties to the smaller id); selections of all blocks are merged per query. Every query meets every candidate block, so the
result is exact; a task holds one query block and one candidate block.

Defined cases: vectors that are NULL or hold a NULL or non-finite component take no part, nor do rows without an id; a
vector may be shorter than others (missing terms weigh 0); weights beyond 64 bits saturate and sums wrap; rows that repeat
an id are the query's own; a query id that comes several times is asked once, with the row that is smallest as an array;
with fewer than k candidates all are returned; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.scratch import cut


@dataclass(frozen=True)
class Params:
    k: int = 20
    scale: float = 64.0
    query_rows: int = 2048
    candidate_rows: int = 4096
    dense_share: float = 0.5


def weighted(vectors: DataFrame, params: Params) -> DataFrame:
    """(vec_id, weights) of the rows that take part."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v"), whole.alias("whole"))
    return rows.filter("vec_id IS NOT NULL AND whole").select(
        "vec_id", F.transform("v", lambda x: F.floor(x * params.scale).cast("long")).alias("weights")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of weights, short ones filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


class Postings:
    """Inverted index of a block of candidate rows, in ascending order of their ids."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, dense_share: float):
        order = np.argsort(ids, kind="stable")
        self.ids, weights = ids[order], weights[order]
        self.terms: list[tuple[np.ndarray | None, np.ndarray]] = []
        for column in weights.T:
            rows = np.flatnonzero(column)
            if len(rows) > dense_share * len(column):
                self.terms.append((None, np.ascontiguousarray(column)))  # a list of nearly all rows is kept as a column
            else:
                self.terms.append((rows, column[rows]))

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ids), dtype=np.int64)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            if term < len(self.terms):
                rows, values = self.terms[term]
                if rows is None:
                    out += weight * values
                else:
                    out[rows] += weight * values
        return out

    def best(self, own: int, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the k best rows but those with the query's own id."""
        low, high = np.searchsorted(self.ids, [own, own + 1])
        place = np.delete(np.arange(len(scores)), slice(low, high)) if high > low else np.arange(len(scores))
        if len(place) > k:
            edge = np.partition(scores[place], len(place) - k)[len(place) - k]
            above = place[scores[place] > edge]
            ties = place[scores[place] == edge][: k - len(above)]  # in ascending order of ids
            place = np.concatenate([above, ties])
        return place


def top_k(queries: DataFrame, candidates: DataFrame, params: Params = Params()) -> DataFrame:
    """The k best candidates of every query: (query_id, rank, vec_id, score)."""
    queries = cut(weighted(queries, params).groupBy("vec_id").agg(F.min("weights").alias("weights")))
    candidates = cut(weighted(candidates, params))
    n_query = max(1, -(-queries.count() // params.query_rows))
    n_candidate = max(1, -(-candidates.count() // params.candidate_rows))
    mine = queries.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(n_query)).alias("q"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_candidate - 1).cast("long"))).alias("c"),
        F.lit(True).alias("query"),
        "vec_id",
        "weights",
    )
    theirs = candidates.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_query - 1).cast("long"))).alias("q"),
        F.pmod(F.xxhash64("weights", "vec_id"), F.lit(n_candidate)).alias("c"),
        F.lit(False).alias("query"),
        "vec_id",
        "weights",
    )
    k, dense = params.k, params.dense_share

    def search(table: pa.Table) -> pa.Table:
        asked = np.asarray(table.column("query"))
        ids, weights = table.column("vec_id").to_numpy(), _matrix(table.column("weights"))
        index = Postings(ids[~asked], weights[~asked], dense)
        found: list[tuple[np.ndarray, ...]] = []
        for own, row in zip(ids[asked], weights[asked]):
            terms = np.flatnonzero(row)
            scores = index.scores(terms, row[terms])
            place = index.best(int(own), scores, k)
            found.append((np.full(len(place), own), index.ids[place], scores[place]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    found = mine.union(theirs).groupBy("q", "c").applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
