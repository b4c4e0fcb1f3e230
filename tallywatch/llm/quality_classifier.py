"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of `passage_words` words. Every passage is described by shares of character kinds, word shapes,
repetition and hashed words, and encoded by a learned layer; gated attention, learned from the labels of whole texts, weighs
the passages, and the weighted sum of their encodings is scored.

The model is fitted on a bounded sample of labelled texts: about `sample_texts` of them, chosen by a hash, with all their
passages; of different texts under one id the first in order is taken. Scoring takes all passages of whole texts in one narrow
pass and holds a few megabytes of text at a time.

Defined cases: a NULL or empty text is one passage without words and gets that passage's score; rows without an id or label
are not learned from, nor are ids whose labels disagree; without any label every score is 0.5; repeated rows get equal
scores; an empty table gives an empty result. Only text is read to score; columns named by `keep` are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm import words as W

_ALONE = "#*$%&|<>!?.,;:\"'()-_/\\@=+~[]{}"  # characters that are a kind of their own
_HASHED = 24
_SHAPES = 8


def _kinds() -> np.ndarray:
    kind = np.full(256, 6, dtype=np.int64)  # control characters
    for low, high, value in ((65, 91, 1), (97, 123, 0), (48, 58, 2), (192, 224, 4), (224, 256, 5)):
        kind[low:high] = value
    kind[W.SPACE] = 3
    for i, c in enumerate(_ALONE):
        kind[ord(c)] = 7 + i
    kind[128:192] = 7 + len(_ALONE)  # continues a character: not counted
    return kind


_KIND = _kinds()
_KINDS = 7 + len(_ALONE)
FEATURES = _KINDS + _SHAPES + _HASHED


@dataclass(frozen=True)
class Params:
    passage_words: int = 64
    sample_texts: int = 4000
    encoded: int = 24
    gated: int = 12
    epochs: int = 30
    batch: int = 128
    rate: float = 4e-3
    decay: float = 1e-4
    seed: int = 11


def passages(run: W.Run, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of a run, and the row each belongs to; every row has at least one."""
    start, end, row = run.words()
    n_words = np.bincount(row, minlength=run.n)
    first_word = np.cumsum(n_words) - n_words
    per_row = np.maximum(-(-n_words // size), 1)
    first = np.cumsum(per_row) - per_row
    total = int(per_row.sum())
    owner = np.repeat(np.arange(run.n), per_row)
    of_word = first[row] + (np.arange(len(row)) - first_word[row]) // size
    out = np.zeros((total, FEATURES), dtype=np.float32)
    if not len(run.data):
        return out, owner
    # a passage's bytes begin where its first word does, but at the row's beginning for the row's first passage
    begin = run.offsets[:-1][owner].copy()
    opens = np.flatnonzero(np.diff(of_word, prepend=-1))
    later = np.arange(total) - first[owner] > 0
    begin[of_word[opens][later[of_word[opens]]]] = start[opens][later[of_word[opens]]]
    lengths = np.diff(np.append(begin, len(run.data)))
    counts = np.zeros((total, _KINDS + 1), dtype=np.int64)
    passage_of_byte = np.repeat(np.arange(total, dtype=np.int32), lengths)
    for at in range(0, len(run.data), W.BLOCK_BYTES):
        part, own = _KIND[run.data[at : at + W.BLOCK_BYTES]], passage_of_byte[at : at + W.BLOCK_BYTES]
        low, high = int(own[0]), int(own[-1]) + 1
        counts[low:high] += np.bincount((own - low) * (_KINDS + 1) + part, minlength=(high - low) * (_KINDS + 1)).reshape(high - low, -1)
    counts = counts[:, :_KINDS]
    out[:, :_KINDS] = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    if not len(start):
        return out, owner
    hashes = W.span_hashes(run.data, start, end)
    n = np.bincount(of_word, minlength=total).astype(np.float64)
    safe = np.maximum(n, 1)
    width = end - start
    tally = lambda flags: np.bincount(of_word, flags, minlength=total) / safe
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    keyed = W.mix(hashes ^ W.mix(of_word.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keyed, kind="stable")
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    shapes = (
        n / size, tally(width) / 10, tally(width <= 3), tally(width >= 12), tally(width >= 25), tally(same), tally(again),
        np.log1p(n_words[owner]) / 10,
    )
    for k, values in enumerate(shapes):
        out[:, _KINDS + k] = values
    bucket = (hashes % np.uint64(_HASHED)).astype(np.int64)
    hashed = np.bincount(of_word * _HASHED + bucket, minlength=total * _HASHED).reshape(total, _HASHED)
    out[:, _KINDS + _SHAPES :] = hashed / safe[:, None]
    return out, owner


@dataclass(frozen=True)
class Model:
    """Weights by name; `middle` and `scale` settle the features."""

    weights: dict[str, np.ndarray]
    middle: np.ndarray
    scale: np.ndarray
    params: Params

    def score(self, features: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Probability of label 1 of each of `n` bags; `owner` is ascending and names every bag."""
        first = np.searchsorted(owner, np.arange(n))
        return 1 / (1 + np.exp(-_forward(self.weights, (features - self.middle) / self.scale, first, owner)["logit"]))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["encode"] + w["encode0"])
    t, s = np.tanh(h @ w["view"] + w["view0"]), 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"])))
    e = (t * s) @ w["attend"]
    a = np.exp(e - np.maximum.reduceat(e, first)[owner])
    a = a / np.add.reduceat(a, first)[owner]
    z = np.add.reduceat(a[:, None] * h, first)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ w["score"] + w["score0"]}


def _gradient(w: dict, x: np.ndarray, first: np.ndarray, owner: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, first, owner)
    error = (1 / (1 + np.exp(-f["logit"])) - label) / len(label)
    dz = error[:, None] * w["score"][None, :]
    da = (f["h"] * dz[owner]).sum(axis=1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[owner])
    dts = de[:, None] * w["attend"][None, :]
    dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
    dh = f["a"][:, None] * dz[owner] + dt @ w["view"].T + ds @ w["gate"].T
    dx = dh * (1 - f["h"] ** 2)
    return {
        "encode": x.T @ dx, "encode0": dx.sum(axis=0), "view": f["h"].T @ dt, "view0": dt.sum(axis=0),
        "gate": f["h"].T @ ds, "gate0": ds.sum(axis=0), "attend": (f["t"] * f["s"]).T @ de,
        "score": f["z"].T @ error, "score0": error.sum(keepdims=True),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, params: Params) -> Model:
    """Fit on bags of passage features by Adam steps over batches of bags."""
    rng = np.random.default_rng(params.seed)
    d, g = params.encoded, params.gated
    shape = {
        "encode": (FEATURES, d), "encode0": (d,), "view": (d, g), "view0": (g,), "gate": (d, g), "gate0": (g,),
        "attend": (g,), "score": (d,), "score0": (1,),
    }
    w = {k: np.zeros(s) if k.endswith("0") else rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shape.items()}
    if not len(bags):
        w["score"][:] = 0
        return Model(w, np.zeros(FEATURES), np.ones(FEATURES), params)
    every = np.concatenate(bags)
    middle, scale = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-2)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w["score0"][:] = np.log(share / (1 - share))
    first_moment = {k: np.zeros_like(v) for k, v in w.items()}
    second_moment = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(params.epochs):
        order = rng.permutation(len(bags))
        rate = params.rate * (1 - epoch / params.epochs)
        for at in range(0, len(order), params.batch):
            own = order[at : at + params.batch]
            x = (np.concatenate([bags[i] for i in own]) - middle) / scale
            sizes = np.array([len(bags[i]) for i in own])
            first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(own)), sizes)
            step += 1
            for k, grad in _gradient(w, x, first, owner, labels[own]).items():
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * grad
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * grad**2
                move = first_moment[k] / (1 - 0.9**step) / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)
                w[k] = w[k] - rate * move - (0 if k.endswith("0") else rate * params.decay * w[k])
    return Model(w, middle, scale, params)


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Fit on a sample of the labelled rows: `docs` has doc_id and text, `labels` doc_id and label (0 or 1)."""
    agreed = (
        labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality sample")), F.lit(1 << 30))
    sample = agreed.filter(place < int((1 << 30) * min(1.0, params.sample_texts / max(agreed.count(), 1))))
    size = params.passage_words

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in W.runs(batch.column("text")):
                features, owner = passages(run, size)
                cuts = np.searchsorted(owner, np.arange(run.n + 1))
                bags = [features[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                part = batch.slice(run.rows.start, run.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"]
                )

    # the sample has about `sample_texts` rows of two numbers, whatever the input
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample.select("doc_id", "label")), "doc_id")
    rows = joined.groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("long").alias("label")).agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text")
    )
    found = rows.mapInArrow(describe, "doc_id long, label long, bag binary").toPandas().sort_values(["doc_id", "bag"])
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES).astype(np.float64) for b in found["bag"]]
    return train(bags, found["label"].to_numpy(dtype=np.float64), params)


def predict(docs: DataFrame, model: Model, keep: list[str], only_kept: bool = False) -> DataFrame:
    """The `keep` columns of every row with score and predicted; or, `only_kept`, of the rows predicted 1 without them."""
    carried = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)]
    fields = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    added = [] if only_kept else [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType(fields + added)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in W.runs(batch.column("_text")):
                features, owner = passages(run, model.params.passage_words)
                score = model.score(features, owner, run.n)
                part = batch.slice(run.rows.start, run.n)
                arrays = [part.column(f"_{i}") for i in range(len(keep))]
                if only_kept:
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names).filter(pa.array(score >= 0.5))
                else:
                    arrays += [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    made = docs.select(*carried, F.col("text").cast("string").alias("_text")).mapInArrow(work, schema)
    return made.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *[f.name for f in added])
