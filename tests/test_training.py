"""Training by epochs against a plain loop over the same examples."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.functions import vectors
from tallywatch.operators import training


def texts_of(spark, n=160):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["good", "fine", "text"] if i % 3 else ["@@#", "!!$", "junk"]) for _ in range(rng.randrange(3, 30))), int(i % 3 > 0)) for i in range(n)]
    return spark.createDataFrame([*rows, (900, None, 1), (901, "", 0), (902, "not labelled", None)], "doc_id long, text string, label int")


CONFIG = training.TrainingConfig(epochs=3, batch_size=40, buckets=512, learning_rate=0.05)


def plain(spark, path, config):
    """Weights after every epoch by one loop over the written examples."""
    rows = spark.read.parquet(f"{path}/examples").collect()
    slots = max(r.slot for r in rows) + 1
    n = Counter(int(r.label) for r in rows)
    heavy = [len(rows) / (2 * n[c]) for c in (0, 1)]
    w, m, v = (np.zeros(config.buckets + 1) for _ in range(3))
    steps, step, out = slots * config.epochs, 0, []
    warm = max(1, int(config.warmup_share * steps))
    for epoch in range(1, config.epochs + 1):
        for slot in np.random.default_rng([config.seed, epoch]).permutation(slots):
            own, grad = [r for r in rows if r.slot == slot], np.zeros_like(w)
            for r in own:
                z = sum(w[p] * x for p, x in zip(r.places, r["values"])) + w[-1]
                error = heavy[int(r.label)] * (1 / (1 + np.exp(-z)) - r.label)
                for p, x in zip(r.places, r["values"]):
                    grad[p] += error * x
                grad[-1] += error
            grad, step = grad / len(own), step + 1
            rate = config.learning_rate * min(step / warm, (steps - step + 1) / max(steps - warm, 1))
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            keep = np.append(np.full(config.buckets, 1 - rate * config.weight_decay), 1)
            w = w * keep - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        out.append(w)
    return out


def weights_of(spark, path):
    kept = spark.read.schema(f"epoch int, {training.CHECKPOINT}").parquet(f"{path}/checkpoints")
    return {r.epoch: np.frombuffer(r.weights) for r in kept.collect()}


def test_epochs_equal_a_plain_loop_and_resume(spark, tmp_path):
    texts, path = texts_of(spark), str(tmp_path)
    done = training.train(texts, texts, f"{path}/one", CONFIG).orderBy("epoch").collect()
    assert [r.epoch for r in done] == [1, 2, 3] and all(r.eval_loss is not None and 0 <= r.eval_f1 <= 1 for r in done)
    found = weights_of(spark, f"{path}/one")
    for epoch, want in enumerate(plain(spark, f"{path}/one", CONFIG), 1):
        assert np.allclose(found[epoch], want, atol=1e-9)
    training.train(texts, texts, f"{path}/two", CONFIG, prepared=f"{path}/one", until=1)
    assert set(weights_of(spark, f"{path}/two")) == {1}
    training.train(texts, texts, f"{path}/two", CONFIG, prepared=f"{path}/one")
    again = weights_of(spark, f"{path}/two")
    assert set(again) == {1, 2, 3} and all(np.allclose(again[e], found[e], atol=1e-9) for e in found)
    model = training.load(spark, f"{path}/one", CONFIG)
    best = max(done, key=lambda r: (r.eval_f1, -r.epoch)).epoch
    assert np.array_equal(model.weights, found[best])
    scored = training.score(model, texts).collect()
    assert len(scored) == 163 and sum(r.predicted_label == r.label for r in scored if r.label is not None) > 140
    assert all(abs(sum(r.probabilities) - 1) < 1e-3 and r.predicted_sentiment in ("POSITIVE", "NEGATIVE") for r in scored)


@pytest.mark.parametrize("run", [1, 30, 8192])
def test_runs_of_any_length_take_the_same_steps_and_few_jobs(spark, tmp_path, monkeypatch, run):
    monkeypatch.setattr(training, "RUN_EXAMPLES", run)
    monkeypatch.setattr(training, "prepare", lambda *a, made=training.prepare: made(*a) or began.append(jobs()))
    began = []

    def jobs():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(tmp_path)))

    spark.sparkContext.setJobGroup(str(tmp_path), "training")
    training.train(texts_of(spark, 240), texts_of(spark, 20), str(tmp_path), training.TrainingConfig(epochs=1, batch_size=10, buckets=64))
    took = jobs() - began[0]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = plain(spark, str(tmp_path), training.TrainingConfig(epochs=1, batch_size=10, buckets=64))
    assert np.allclose(weights_of(spark, str(tmp_path))[1], want[0], atol=1e-9)
    assert took < 24 or run < 8192  # 25 mini-batches


def test_search_tries_the_grid_on_the_same_examples(spark, tmp_path):
    texts = texts_of(spark, 60)
    grid = [{"learning_rate": 0.0001}, {"learning_rate": 0.1, "weight_decay": 0.0}]
    trials = training.search(texts, texts, str(tmp_path), grid, training.TrainingConfig(epochs=2, batch_size=40, buckets=256)).orderBy("trial").collect()
    assert [(r.trial, r.learning_rate, r.weight_decay) for r in trials] == [(0, 0.0001, None), (1, 0.1, 0.0)]
    assert [r.best for r in trials].count(True) == 1 and max(trials, key=lambda r: (r.eval_f1, -r.trial)).best
    with pytest.raises(ValueError):
        training.search(texts, texts, str(tmp_path), [{"buckets": 3}])


def test_quick_run_bounds_and_odd_labels(spark, tmp_path):
    texts = texts_of(spark, 20)
    with pytest.raises(ValueError):
        training.quick_run(texts, texts, str(tmp_path), max_samples=99)
    with pytest.raises(ValueError):
        training.train(texts.withColumn("label", texts.label + 1), texts, str(tmp_path / "odd"))
    empty = training.train(texts.limit(0), texts.limit(0), str(tmp_path / "none"), training.TrainingConfig(epochs=1, buckets=16)).collect()
    assert [(r.epoch, r.step, r.train_loss, r.eval_loss) for r in empty] == [(1, 0, 0.0, None)]


def test_gram_and_term_counts():
    texts = ["abcab", None, "", "AbC", "éa", "x"]
    found = Counter()
    for rows, data, offsets in vectors.text_runs(pa.array(texts), 4):
        for r, p, n in zip(*vectors.gram_counts(data, offsets, 3, 1 << 20)):
            found[rows.start + int(r), int(p)] += int(n)
    per_row = {i: sorted(n for (r, _), n in found.items() if r == i) for i in range(6)}
    assert per_row == {0: [1, 1, 1], 1: [], 2: [], 3: [1], 4: [1], 5: []}
    assert {p for (r, p) in found if r == 3} < {p for (r, p) in found if r == 0}  # "AbC" is "abc"
    row, place, count = vectors.term_counts(pa.array([["b", "a", "b", "z"], None, [], ["z"], ["a"]]), pa.array(["a", "b"]))
    assert list(zip(row.tolist(), place.tolist(), count.tolist())) == [(0, 0, 1), (0, 1, 2), (4, 0, 1)]
    assert vectors.lists(row, count, 5).to_pylist() == [[1, 2], [], [], [], [1]]


def test_runs_of_lists_are_bounded_and_whole():
    lists = [["a"] * n for n in (3, 0, 9, 2, 2)] + [None, ["b"]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists), pa.array(range(7))], names=["x", "id"])
    runs = list(vectors.list_runs(iter([batch, batch.slice(7)]), "x", 4))
    assert [r.column("id").to_pylist() for r in runs] == [[0, 1], [2], [3, 4, 5], [6]]
    assert [x for r in runs for x in r.column("x").to_pylist()] == lists
