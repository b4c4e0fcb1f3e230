"""Hard-negative mining by angular triangle filtering.

Every vector is stored with its angles to a few fixed reference directions and its norm. By the triangle inequality of
angles, the angle between an anchor and a row lies between the largest difference and the smallest sum of their angles to
the same direction; the cosines of these limits, multiplied by both norms and rounded outwards, bound the integer score. Only
rows whose bounds can matter are scored: for positives those of the anchor's label whose upper bound reaches the score of its
n-th best, for negatives those of other labels whose bounds overlap the score window of one of its positives. Anchors and rows are dealt in blocks, every anchor block meets every row block, and the best of all
blocks are merged by rank, so the result is exact. A task holds one block of each.

Scores are sums of products of the integers floor(scale * x). Directions are `references` rows of the table, drawn by a hash
of their values; any directions give right results, these only decide how many pairs are scored.

Defined cases: rows without id or label take no part, nor do vectors that are NULL or hold a NULL or non-finite component; a
vector may be shorter than others (missing components are 0); components beyond 64 bits saturate and sums wrap, and pairs whose norms
could exceed 62 bits are always scored; rows that repeat an anchor's id are the anchor's own and neither its positives nor its
negatives; an anchor id that comes several times is asked once, with the row that is smallest by label and vector; other
rows that repeat an id are rows of their own; equal scores are ordered by id; an anchor without positives, a positive without
negatives and an empty table give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.scratch import cut
from tallywatch.llm.vector_search import _matrix

SLACK = 2e-7  # radians; an arc cosine of doubles is wrong by 1e-7 at most, near 0 and pi


@dataclass(frozen=True)
class Params:
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30  # of the positive's score
    high_percent: int = 90
    scale: float = 256.0
    references: int = 16
    anchor_rows: int = 1024
    block_rows: int = 4096


def stored(rows: DataFrame, params: Params, directions: np.ndarray | None = None) -> DataFrame:
    """(vec_id, label, weights) of the rows that take part, with norm and angles to the directions where these are given."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taking = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), values.alias("v"), whole.alias("whole"))
    weighted = taking.filter("vec_id IS NOT NULL AND label IS NOT NULL AND whole").select(
        "vec_id", "label", F.transform("v", lambda x: F.floor(x * params.scale).cast("long")).alias("weights")
    )
    if directions is None:
        return weighted

    def angles(parts):
        for batch in parts:
            w = _matrix(batch.column("weights")).astype(np.float64)
            norm, theta = angles_of(w, directions)
            listed = pa.array(list(theta), pa.list_(pa.float64())) if len(w) else pa.array([], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), listed], names=["vec_id", "label", "weights", "norm", "angles"])

    return weighted.mapInArrow(angles, "vec_id long, label string, weights array<long>, norm double, angles array<double>")


def angles_of(weights: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to unit vectors; a vector of zeros is taken to stand at a right angle to all."""
    width = max(weights.shape[1], directions.shape[1])
    weights, directions = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (weights, directions))
    norm = np.sqrt((weights * weights).sum(axis=1))
    return norm, np.arccos(np.clip(weights @ directions.T / np.maximum(norm, 1e-300)[:, None], -1, 1))


def directions_of(rows: DataFrame, params: Params) -> np.ndarray:
    """Unit vectors of a fixed number of rows, drawn by a hash."""
    drawn = rows.filter(F.exists("weights", lambda x: x != 0)).orderBy(F.xxhash64("weights"), "weights").select("weights").limit(params.references)
    found = _matrix(drawn.toArrow().column("weights")).astype(np.float64)
    return found / np.sqrt((found * found).sum(axis=1))[:, None] if len(found) else np.zeros((0, 0))


class Block:
    """Rows of a block as arrays, in ascending order of ids."""

    def __init__(self, table: pa.Table):
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], np.asarray(table.column("label").to_pylist(), dtype=object)[order]
        self.weights, self.norm = _matrix(table.column("weights"))[order], table.column("norm").to_numpy()[order]
        angles = np.asarray(table.column("angles").combine_chunks().flatten(), dtype=np.float64)
        self.angles = angles.reshape(len(ids), len(angles) // max(len(ids), 1))[order]

    def bounds(self, norm: float, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores with a vector of this norm and these angles."""
        least, most = np.zeros(len(self.ids)), np.full(len(self.ids), np.pi)
        for mine, theirs in zip(self.angles.T, angles.tolist()):
            np.maximum(least, np.abs(mine - theirs), out=least)
            total = mine + theirs
            np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
        product = norm * self.norm
        margin = 1 + product * 1e-12
        low = np.floor(product * np.cos(np.minimum(most + SLACK, np.pi)) - margin)
        high = np.ceil(product * np.cos(np.maximum(least - SLACK, 0)) + margin)
        wide = product >= 2.0**62
        low[wide], high[wide] = -np.inf, np.inf
        return low, high

    def scores(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        width = min(len(weights), self.weights.shape[1])
        return (self.weights[rows, :width] * weights[None, :width]).sum(axis=1)


def best(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, equal ones in the order given (that of the ids)."""
    if len(scores) > n:
        edge = np.partition(scores, len(scores) - n)[len(scores) - n]
        place = np.flatnonzero(scores >= edge)
        return place[np.argsort(-scores[place], kind="stable")[:n]]
    return np.argsort(-scores, kind="stable")


def positives_in(block: Block, own: int, label: str, weights: np.ndarray, norm: float, angles: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best n rows of the anchor's label, scored in descending order of their upper bounds."""
    rows = np.flatnonzero((block.labels == label) & (block.ids != own))
    high = block.bounds(norm, angles)[1][rows]
    order = rows[np.argsort(-high, kind="stable")]
    high = np.sort(high)[::-1]
    scored, scores, at = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
    while at < len(order):
        if len(scores) >= n and high[at] < np.partition(scores, len(scores) - n)[len(scores) - n]:
            break
        part = order[at : at + max(64, 4 * n)]
        scored, scores, at = np.append(scored, part), np.append(scores, block.scores(part, weights)), at + len(part)
    by_id = np.argsort(scored, kind="stable")
    scored, scores = scored[by_id], scores[by_id]
    place = best(scores, n)
    return block.ids[scored[place]], scores[place]


def negatives_in(
    block: Block, own: int, label: str, weights: np.ndarray, norm: float, angles: np.ndarray, limits: list[tuple[int, int]], n: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores (both ends included): ids and scores of the best n rows of other labels within it."""
    low, high = block.bounds(norm, angles)
    other = (block.labels != label) & (block.ids != own)
    open_ = np.zeros(len(other), dtype=bool)
    for least, most in limits:
        open_ |= (high >= least) & (low <= most)
    rows = np.flatnonzero(open_ & other)
    scores = block.scores(rows, weights)
    out = []
    for least, most in limits:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        place = inside[best(scores[inside], n)]
        out.append((block.ids[rows[place]], scores[place]))
    return out


def _dealt(anchors: DataFrame, rows: DataFrame, params: Params, extra: str) -> DataFrame:
    """Blocks of anchors with blocks of rows; anchors carry the column `extra`."""
    n_anchor = max(1, -(-anchors.count() // params.anchor_rows))
    n_rows = max(1, -(-rows.count() // params.block_rows))
    columns = ["vec_id", "label", "weights", "norm", "angles"]

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    mine = anchors.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_anchor)).alias("a"), all_of(n_rows).alias("b"), *columns, extra)
    theirs = rows.select(all_of(n_anchor).alias("a"), F.pmod(F.xxhash64("weights", "vec_id"), F.lit(n_rows)).alias("b"), *columns)
    return mine.unionByName(theirs, allowMissingColumns=True).groupBy("a", "b")


def _each(table: pa.Table, extra: str, work: Callable) -> pa.Table | None:
    asked = table.filter(table.column(extra).is_valid())
    block = Block(table.filter(table.column(extra).is_null()))
    anchors = Block(asked)
    carried = dict(zip(asked.column("vec_id").to_pylist(), asked.column(extra).to_pylist()))
    for i, own in enumerate(anchors.ids.tolist()):
        work(block, own, anchors.labels[i], anchors.weights[i], float(anchors.norm[i]), anchors.angles[i], carried[own])


def positives(anchors: DataFrame, rows: DataFrame, params: Params) -> DataFrame:
    """(anchor_id, place, positive_id, positive_score): the first rows of an anchor's label, place counts from 1."""
    n = params.positives

    def search(table: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.int64),) * 3]

        def work(block, own, label, weights, norm, angles, _):
            ids, scores = positives_in(block, own, label, weights, norm, angles, n)
            found.append((np.full(len(ids), own), ids, scores))

        _each(table, "asked", work)
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), (np.concatenate(c) for c in zip(*found)))))

    made = _dealt(anchors.withColumn("asked", F.lit(True)), rows, params, "asked").applyInArrow(search, "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id"))
    return made.withColumn("place", place).filter(F.col("place") <= n)


def mine(anchors: DataFrame, rows: DataFrame, params: Params = Params()) -> DataFrame:
    """The hardest negatives of every anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    n, low, high = params.negatives, params.low_percent, params.high_percent
    directions = directions_of(stored(rows, params), params)
    kept = cut(stored(rows, params, directions))
    firsts = stored(anchors, params, directions).groupBy("vec_id").agg(F.min(F.struct("label", "weights", "norm", "angles")).alias("r"))
    asked = cut(firsts.select("vec_id", "r.*"))
    found = cut(positives(asked, kept, params))
    listed = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    with_positives = asked.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id")

    def search(table: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.int64),) * 6]

        def work(block, own, label, weights, norm, angles, found):
            limits = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in found]
            for p, (ids, scores) in zip(found, negatives_in(block, own, label, weights, norm, angles, limits, n)):
                out.append((*(np.full(len(ids), v) for v in (own, p["place"], p["positive_id"], p["positive_score"])), ids, scores))

        _each(table, "positives", work)
        names = ("anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table(dict(zip(names, (np.concatenate(c).astype(np.int64) for c in zip(*out)))))

    schema = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    made = _dealt(with_positives, kept, params, "positives").applyInArrow(search, schema)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id"))
    return made.withColumn("rank", rank).filter(F.col("rank") <= n).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
      CAST(list_sum(list_transform(range(1, len(a.w) + 1), lambda i: a.w[i] * b.w[i])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS "rank",
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY "rank" <= 10"""
