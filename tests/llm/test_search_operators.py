"""Lexical search, decontamination and hard negatives against slow plain forms."""

from __future__ import annotations

import hashlib
import math
import random
import re
from itertools import product

import numpy as np
import pytest
from helpers import CLASHING, LOWER, awkward, empty, prose
from pyspark.sql import functions as F

from tallywatch.llm import decontamination, hard_negatives, lexical_search
from tallywatch.llm import words as W

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text) -> list[str]:
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def items_of(spark, docs):
    """Items of whole texts, parts of them, text of no document, and awkward rows."""
    texts = [r["text"] for r in docs.collect()]
    long = max((t for t in texts if t), key=len)
    rows = [(1, " ".join(long.split()[100:130])), (2, " ".join(long.split()[20_000:20_004])), (3, None), (4, ""), (5, "one"), (6, "the the of"),
            (7, "words that no document holds zzz"), (7, "same words again same words again same words"), (None, "日本語"), (9, prose(2, 60))]
    return spark.createDataFrame(rows, ITEMS), rows


# --- lexical search ---------------------------------------------------------------------------------------------------


def ranked(items, docs, k=10):
    """[(item_id, [(doc_id, score)])] by scoring every document for every item."""
    split = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df: dict[str, int] = {}
    for _, t in split:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        found = []
        for doc, t in split:
            m = 10 + (90 * len(t) * n_docs) // max(total, 1)
            score = 0
            for term in set(terms(text)):
                if tf := t.count(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, rank + 1, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("params", [lexical_search.Params(), lexical_search.Params(k=3, slots_per_term=1, items_a_batch=4, chunk=2)])
def test_search_equals_scoring_everything(spark, params):
    docs = awkward(spark)
    items, rows = items_of(spark, docs)
    found = lexical_search.rank(items.withColumns({c: F.lit("x") for c in CLASHING}), docs.repartition(3), params).collect()
    assert sorted([tuple(r) for r in found], key=repr) == ranked(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], params.k)


def test_search_of_many_documents_scores_few_of_them(spark):
    rng = random.Random(3)
    texts = [prose(rng.randrange(10**6), rng.randrange(5, 200)) for _ in range(600)] + ["quick brown foxes jump over lazy dogs " + prose(9, 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(0, "lazy foxes"), (1, prose(77, 12))]
    found = lexical_search.rank(spark.createDataFrame(items, ITEMS), docs).collect()
    assert sorted([tuple(r) for r in found], key=repr) == ranked(items, list(enumerate(texts)))
    run = next(W.runs(__import__("pyarrow").array(texts)))
    sketches = lexical_search.Sketches(run, 601, 60_000, 4)
    asked = lexical_search.items_of(__import__("pyarrow").array([0]), __import__("pyarrow").array(["lazy foxes"]))
    best = lexical_search.Best(1)
    weights = np.full(len(asked.vocabulary), 5000)
    bounds = sketches.bounds(asked.vocabulary, weights)
    assert (bounds >= sketches.scores(np.arange(601), asked.vocabulary, weights)).all()
    scored = lexical_search.search_run(sketches, np.arange(601), np.zeros(601, dtype=bool), asked.vocabulary, weights, best, 8)
    assert best.ids.tolist() == [600] and scored < 200


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert lexical_search.rank(items, empty(spark)).count() == 0
    assert lexical_search.rank(items.limit(0), awkward(spark)).count() == 0
    assert lexical_search.rank(items.withColumn("text", F.lit(None).cast("string")), awkward(spark)).count() == 0


# --- decontamination --------------------------------------------------------------------------------------------------


def windows(text, width=10):
    t = terms(text)
    n = min(width, len(t))
    return {tuple(t[i : i + n]) for i in range(len(t) - n + 1)} if t else set()


def hits(docs, items):
    out = []
    for doc, text in docs:
        t, hit, named = terms(text), set(), set()
        for item, asked in items:
            for w in windows(asked):
                for i in range(len(t) - len(w) + 1):
                    if tuple(t[i : i + len(w)]) == w:
                        hit |= set(range(i, i + len(w)))
                        named |= {item} - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
        out.append((doc, len(t), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("params", [decontamination.Params(), decontamination.Params(run_bytes=300, items_a_batch=3)])
def test_phrases_equal_a_scan_of_all_texts(spark, params):
    docs = awkward(spark).filter("doc_id IS NULL OR doc_id <> 8")
    items, rows = items_of(spark, docs)
    index = decontamination.build(docs.repartition(2), params)
    found = decontamination.verdicts(index, decontamination.phrases(index, items.withColumns({c: F.lit("x") for c in CLASHING}), params))
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted([tuple(r) for r in found.collect()], key=repr) == hits([(r["doc_id"], r["text"]) for r in docs.collect()], rows)


def test_windows_do_not_cross_documents_and_spans_touch(spark):
    docs = [(1, "a b c"), (2, "d e"), (3, "a b c d e"), (4, "x a b"), (5, "a b a b x x")]
    items = [(1, "c d"), (2, "a b"), (3, "x")]
    index = decontamination.build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    found = decontamination.verdicts(index, decontamination.phrases(index, spark.createDataFrame(items, ITEMS)))
    assert sorted([tuple(r) for r in found.collect()], key=repr) == hits(docs, items)


def test_proximity_equals_trying_every_interval(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    items = [(1, "a b c"), (2, "a a b"), (3, "h g f e d"), (4, "zz a"), (None, "a b"), (6, " ".join("abcdefgh"))]
    params = decontamination.Params(width=4, span=6, run_bytes=200)
    index = decontamination.build(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), params)
    want = set()
    for (doc, text), (item, asked) in product(docs, items):
        t = terms(text)
        for w, i in product(windows(asked, 4), range(len(t))):
            part = t[i : i + 6]
            if all(part.count(x) >= w.count(x) for x in w):
                want.add((doc, item))
    found = decontamination.near(index, spark.createDataFrame(items, ITEMS), params).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)
    texts = dict(docs)
    for r in found:
        part = terms(texts[r["doc_id"]])[r["start"] : r["start"] + 6]
        asked = next(t for i, t in items if i == r["item_id"])
        assert any(all(part.count(x) >= w.count(x) for x in w) for w in windows(asked, 4))


def test_decontamination_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    index = decontamination.build(empty(spark))
    assert decontamination.verdicts(index, decontamination.phrases(index, items)).count() == 0
    index = decontamination.build(awkward(spark))
    for none in (items.limit(0), items.withColumn("text", F.lit("!"))):
        clean = decontamination.verdicts(index, decontamination.phrases(index, none))
        assert clean.filter("contaminated OR n_hit > 0 OR n_items > 0").count() == 0 and clean.count() == awkward(spark).count()


# --- hard negatives ---------------------------------------------------------------------------------------------------


def mined(rows, params=hard_negatives.Params(), every=100):
    kept = [(i, label, [math.floor(params.scale * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors: dict = {}
    for i, label, v in sorted(kept, key=lambda r: (r[0], str(r[1]), r[2])):
        if i % every == 0:
            anchors.setdefault(i, (label, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, other, w in kept if i != a)
        for score, p, _ in [s for s in scored if s[2]][: params.positives]:
            inside = [s for s in scored if not s[2] and params.low_percent * -score <= 100 * -s[0] <= params.high_percent * -score]
            out += [(a, p, rank + 1, n, -score, -s) for rank, (s, n, _) in enumerate(inside[: params.negatives])]
    return sorted(out)


SCHEMA = "vec_id long, label int, embedding array<float>"


def vectors(seed: int, n: int, size: int, classes: int, spread: float):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(classes, size))
    labels = rng.integers(0, classes, n)
    made = (centres[labels] + spread * rng.normal(size=(n, size))).astype(np.float32)
    return [(i, int(label), v.tolist()) for i, label, v in zip(range(n), labels, made)]


@pytest.mark.parametrize("spread", [0.1, 3.0])
def test_negatives_equal_scoring_everything(spark, spread):
    rows = vectors(1, 400, 8, 3, spread)
    rows += [(500, None, [1.0] * 8), (600, 1, None), (700, 1, [1.0, None] + [0.0] * 6), (800, 1, [float("nan")] * 8), (None, 1, [1.0] * 8),
             (900, 1, [0.0] * 8), (1000, 2, [1.0, 2.0]), (1000, 1, [1.0, 1.0]), (41, 0, rows[41][2]), (200, 1, [5.0] * 8), (1100, 1, [])]
    params = hard_negatives.Params(anchor_rows=3, block_rows=50)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING if c != "label"})
    found = hard_negatives.mine(df.filter("vec_id % 100 = 0"), df, params)
    assert sorted(tuple(r) for r in found.collect()) == mined(rows, params)


def test_bounds_hold_and_save_scores():
    rng = np.random.default_rng(2)
    centres = 300 * rng.normal(size=(8, 16))
    weights = np.floor(centres[rng.integers(0, 8, 500)] + 10 * rng.normal(size=(500, 16))).astype(np.int64)
    weights[0], weights[1], weights[2] = 0, weights[3], -weights[3]
    directions = centres / np.sqrt((centres**2).sum(axis=1))[:, None]
    norm, angles = hard_negatives.angles_of(weights.astype(float), directions)
    block = hard_negatives.Block.__new__(hard_negatives.Block)
    block.ids, block.weights, block.norm, block.angles = np.arange(500), weights, norm, angles
    open_ = 0
    for i in range(500):
        low, high = block.bounds(float(norm[i]), angles[i])
        scores = weights @ weights[i]
        assert (low <= scores).all() and (scores <= high).all()
        open_ += int((high >= 0.9 * scores[i]).sum())
    assert open_ < 0.4 * 500 * 500  # most rows of other centres are never scored


def test_negatives_of_empty_tables_and_few_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(none, none).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0, 0.0]), (1, 2, [1.0, 0.0])], SCHEMA)
    assert hard_negatives.mine(alone.filter("vec_id = 0"), alone).count() == 0  # no positive
    zero = [(0, 1, [0.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.0, 0.0]), (3, 2, [1.0, 1.0])]
    df = spark.createDataFrame(zero, SCHEMA)
    assert sorted(tuple(r) for r in hard_negatives.mine(df.filter("vec_id = 0"), df).collect()) == mined(zero)
