"""Training a text classifier by epochs: mini-batches, decoupled weight decay, checkpoints and resuming.

Examples are hashed character n-grams of whole texts, made once where the texts are read and written with their mini-batch as
a partition of the table, so that a step reads its own files alone. Steps follow each other: a job makes those of some thousand
examples, reading one mini-batch after another, and hands the model on to the next job. A larger mini-batch is a job of its
own, whose gradient is summed over partitions by Spark. The driver holds the model (one number per bucket) and its moments.
After every epoch the model, its moments and the metrics over the validation texts are written as a checkpoint, which
`best_checkpoint` ranks and training resumes from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.files import existing
from tallywatch.functions.vectors import flat, gram_counts, lists, text_runs, unit_length
from tallywatch.operators.datasets import shuffled_sample
from tallywatch.operators.experiments import best_checkpoint
from tallywatch.operators.scoring import from_probabilities, weighted_metrics

EXAMPLES = "label double, places array<int>, values array<double>"
CLASSES = "label double, n long, slots int"
RUN = "step long, loss double, seen double, weights binary, first_moment binary, second_moment binary"
RUN_EXAMPLES = 8192  # examples whose mini-batches one job goes through
CHECKPOINT = (
    "step long, train_loss double, eval_loss double, eval_accuracy double, eval_precision double, eval_recall double, "
    "eval_f1 double, weights binary, first_moment binary, second_moment binary"
)


@dataclass(frozen=True)
class TrainingConfig:
    epochs: int = 3
    batch_size: int = 512
    learning_rate: float = 0.05
    weight_decay: float = 0.01
    warmup_share: float = 0.1  # of all steps; the rate grows up to there and then falls to 0
    balanced: bool = True  # classes weigh alike whatever their number of examples
    gram: int = 3
    buckets: int = 1 << 13
    seed: int = 42


@dataclass(frozen=True)
class Trained:
    """Weights of the buckets, the intercept last."""

    weights: np.ndarray
    config: TrainingConfig


def _features(column: pa.Array, config: TrainingConfig) -> Iterator[tuple[slice, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, their number, row, bucket, value): square roots of n-gram counts, scaled to unit length per text."""
    for rows, data, offsets in text_runs(column):
        row, place, count = gram_counts(data, offsets, config.gram, config.buckets)
        yield rows, len(offsets) - 1, row, place, unit_length(row, np.sqrt(count), len(offsets) - 1)


def examples(texts: DataFrame, config: TrainingConfig, column: str = "text") -> DataFrame:
    """(label, places, values) of the labelled texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, n, row, place, value in _features(batch.column("text"), config):
                arrays = [batch.column("label")[rows], lists(row, place.astype(np.int32), n), lists(row, value, n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["label", "places", "values"])

    labelled = texts.filter(F.col("label").isNotNull())
    return labelled.select(F.col("label").cast("double").alias("label"), F.col(column).alias("text")).mapInArrow(make, EXAMPLES)


def _sum_of(parts: DataFrame) -> np.ndarray:
    """Sum of an array column over all rows, place by place; only the sums reach the driver."""
    summed = parts.select(F.posexplode("part").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(summed.num_rows)
    out[summed.column("place").to_numpy()] = summed.column("x").to_numpy()
    return out


def _margins(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    row, place = flat(batch.column("places"))
    value = flat(batch.column("values"))[1]
    return np.bincount(row, weights[place] * value, minlength=batch.num_rows) + weights[-1], row, place, value


def _loss(z: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z) - label * z


def _add_gradient(total: np.ndarray, batch: pa.RecordBatch, weights: np.ndarray, class_weights: np.ndarray) -> None:
    """Add the examples' gradient of the weighted logistic loss, the loss and their number to `total`."""
    z, row, place, value = _margins(batch, weights)
    label = np.asarray(batch.column("label"))
    weight = class_weights[label.astype(np.int64)]
    error = weight * (1 / (1 + np.exp(-z)) - label)
    total[: len(weights) - 1] += np.bincount(place, value * error[row], minlength=len(weights) - 1)
    total[len(weights) - 1 :] += error.sum(), (weight * _loss(z, label)).sum(), len(label)


def gradient(rows: DataFrame, weights: np.ndarray, class_weights: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Summed gradient of the weighted logistic loss, the loss and the number of examples, over the rows of a table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights) + 2)
        for batch in batches:
            _add_gradient(total, batch, weights, class_weights)
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["part"])

    total = _sum_of(rows.select("label", "places", "values").mapInArrow(work, "part array<double>"))
    return (total[:-2], float(total[-2]), float(total[-1])) if len(total) else (np.zeros(len(weights)), 0.0, 0.0)


def run_steps(rows: DataFrame, run: Sequence[int], weights: np.ndarray, moments: Moments, class_weights: np.ndarray,
              config: TrainingConfig, steps: int) -> tuple[np.ndarray, Moments, float, float]:
    """The model and its moments after a step on each mini-batch of the run in its order, the loss and the number of examples.

    One task reads the run's examples in order and holds no more of them than an Arrow batch.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, own, total, at = weights, Moments(moments.first, moments.second, moments.step), np.zeros(len(weights) + 2), None
        loss = seen = 0.0

        def step() -> None:
            nonlocal model, loss, seen
            model = own.update(model, total[:-2] / total[-1], config, steps)
            loss, seen = loss + total[-2], seen + total[-1]
            total[:] = 0

        for batch in batches:
            place = np.asarray(batch.column("at"))
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            for begin, end in zip(starts, [*starts[1:], len(place)]):
                if at is not None and at != place[begin]:
                    step()
                at = place[begin]
                _add_gradient(total, batch.slice(begin, end - begin), model, class_weights)
        if at is not None:
            step()
            kept = [pa.array([x.tobytes()], pa.binary()) for x in (model, own.first, own.second)]
            yield pa.RecordBatch.from_arrays([pa.array([own.step]), pa.array([loss]), pa.array([seen]), *kept], names=[c.split()[0] for c in RUN.split(", ")])

    chosen = rows.filter(F.col("slot").isin(list(run))).withColumn("at", F.array_position(F.lit(list(run)), F.col("slot")))
    ordered = chosen.select("label", "places", "values", "at").coalesce(1).sortWithinPartitions("at")
    made = ordered.mapInArrow(work, RUN).collect()
    if not made:  # no mini-batch of the run has an example
        return weights, moments, 0.0, 0.0
    done = made[0]
    model, first, second = (np.frombuffer(done[c]).copy() for c in ("weights", "first_moment", "second_moment"))
    return model, Moments(first, second, done["step"]), done["loss"], done["seen"]


def evaluate(rows: DataFrame, weights: np.ndarray) -> dict[str, float]:
    """Loss and weighted metrics over a table of examples."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _margins(batch, weights)[0]
            label = np.asarray(batch.column("label"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(label.astype(np.int32)), pa.array((z > 0).astype(np.int32)), pa.array(_loss(z, label))],
                names=["label", "predicted_label", "loss"],
            )

    scored = rows.select("label", "places", "values").mapInArrow(work, "label int, predicted_label int, loss double")
    counts = scored.groupBy("label", "predicted_label").agg(F.count("*").alias("n"), F.sum("loss").alias("loss")).cache()
    try:
        found = weighted_metrics(counts.select("label", "predicted_label", "n"), weight="n").first()
        loss = counts.agg(F.sum("loss") / F.sum("n")).first()[0]
    finally:
        counts.unpersist()
    names = ("accuracy", "precision", "recall", "f1")
    return {"eval_loss": loss} | {f"eval_{m}": found[m] if found else None for m in names}


class Moments:
    """First and second moments of the gradient, and the steps that use them."""

    def __init__(self, first: np.ndarray, second: np.ndarray, step: int = 0):
        self.first, self.second, self.step = first, second, step

    def update(self, weights: np.ndarray, grad: np.ndarray, config: TrainingConfig, steps: int) -> np.ndarray:
        """Weights after an adaptive step; decay is taken from the weights themselves, not from the gradient."""
        self.step += 1
        warm = max(1, int(config.warmup_share * steps))
        rate = config.learning_rate * min(self.step / warm, max(steps - self.step + 1, 0) / max(steps - warm, 1))
        self.first = 0.9 * self.first + 0.1 * grad
        self.second = 0.999 * self.second + 0.001 * grad * grad
        move = self.first / (1 - 0.9**self.step) / (np.sqrt(self.second / (1 - 0.999**self.step)) + 1e-8)
        decay = config.weight_decay * weights
        decay[-1] = 0  # the intercept does not decay
        return weights - rate * (move + decay)


def prepare(train: DataFrame, validation: DataFrame, path: str, config: TrainingConfig, column: str = "text") -> None:
    """Write the examples of both sides: training examples by mini-batch, about `batch_size` in each."""
    spark = train.sparkSession
    n = train.filter(F.col("label").isNotNull()).count()
    slots = max(1, -(-n // config.batch_size))
    made = examples(train, config, column).withColumn("slot", F.floor(F.rand(config.seed) * slots).cast("int"))
    made.repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(f"{path}/examples")
    examples(validation, config, column).write.mode("overwrite").parquet(f"{path}/validation")
    written = spark.read.schema(f"{EXAMPLES}, slot int").parquet(f"{path}/examples")
    classes = written.groupBy("label").agg(F.count("*").alias("n")).withColumn("slots", F.lit(slots))
    classes.write.mode("overwrite").parquet(f"{path}/classes")  # written last: its presence says that all is there


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The metric rows of a run's checkpoints, one per epoch."""
    found = existing(spark, f"{path}/checkpoints", f"epoch int, {CHECKPOINT}")
    found = spark.createDataFrame([], f"epoch int, {CHECKPOINT}") if found is None else found
    return found.drop("weights", "first_moment", "second_moment")


def train(train_texts: DataFrame, validation: DataFrame, path: str, config: TrainingConfig = TrainingConfig(), column: str = "text",
          prepared: str | None = None, until: int | None = None) -> DataFrame:
    """Train on the labelled texts (labels 0 and 1) and return the metric rows of all epochs.

    What is under `path` is gone on with: examples are made once, and training resumes after the last whole epoch.
    `prepared` names a folder whose examples are used instead; `until` ends this call after that epoch.
    """
    spark = train_texts.sparkSession
    source = prepared or path
    if existing(spark, f"{source}/classes", CLASSES) is None:
        prepare(train_texts, validation, source, config, column)
    classes = {int(r["label"]): r for r in spark.read.schema(CLASSES).parquet(f"{source}/classes").collect()}
    total, slots = sum(r["n"] for r in classes.values()), max([r["slots"] for r in classes.values()], default=0)
    if set(classes) - {0, 1}:
        raise ValueError(f"labels are {sorted(classes)}, not 0 and 1")
    counts = np.array([classes[c]["n"] if c in classes else 0 for c in (0, 1)], dtype=float)
    class_weights = total / (2 * np.maximum(counts, 1)) if config.balanced else np.ones(2)
    rows = spark.read.schema(f"{EXAMPLES}, slot int").parquet(f"{source}/examples")
    held = spark.read.schema(EXAMPLES).parquet(f"{source}/validation")
    weights = np.zeros(config.buckets + 1)
    moments, done = Moments(np.zeros_like(weights), np.zeros_like(weights)), 0
    kept = existing(spark, f"{path}/checkpoints", f"epoch int, {CHECKPOINT}")
    if kept is not None and (last := kept.orderBy(F.col("epoch").desc()).first()):
        weights, first, second = (np.frombuffer(last[c]).copy() for c in ("weights", "first_moment", "second_moment"))
        moments, done = Moments(first, second, last["step"]), last["epoch"]
    for epoch in range(done + 1, min(config.epochs, until or config.epochs) + 1):
        loss = seen = 0.0
        order = np.random.default_rng([config.seed, epoch]).permutation(slots).tolist()
        size = max(1, RUN_EXAMPLES // config.batch_size)
        for run in (order[i : i + size] for i in range(0, slots, size)):
            if size > 1:
                weights, moments, part, n = run_steps(rows, run, weights, moments, class_weights, config, slots * config.epochs)
            else:
                grad, part, n = gradient(rows.filter(F.col("slot") == run[0]), weights, class_weights)
                weights = moments.update(weights, grad / n, config, slots * config.epochs) if n else weights
            loss, seen = loss + part, seen + n
        metrics = evaluate(held, weights)
        row = (moments.step, float(loss / max(seen, 1)), *metrics.values(), *(x.tobytes() for x in (weights, moments.first, moments.second)))
        spark.createDataFrame([row], CHECKPOINT).coalesce(1).write.mode("overwrite").parquet(f"{path}/checkpoints/epoch={epoch}")
    return checkpoints(spark, path)


def load(spark: SparkSession, path: str, config: TrainingConfig, metric: str = "eval_f1", highest: bool = True) -> Trained:
    """The model of the best checkpoint, the earliest of equals; by `metric` epoch, the last one."""
    kept = spark.read.schema(f"epoch int, {CHECKPOINT}").parquet(f"{path}/checkpoints")
    ranked = kept.select(F.lit(path).alias("run"), "epoch", F.col(metric).alias("metric"))
    best = best_checkpoint(ranked, ["run"], "metric", highest).first()["epoch"]
    return Trained(np.frombuffer(kept.filter(F.col("epoch") == best).first()["weights"]).copy(), config)


def score(model: Trained, texts: DataFrame, column: str = "text") -> DataFrame:
    """Label, sentiment, confidence and probabilities of every text; a NULL text is an empty one."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, n, row, place, value in _features(batch.column(column), model.config):
                z = np.bincount(row, model.weights[place] * value, minlength=n) + model.weights[-1]
                part = batch.slice(rows.start, n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-z)))], names=[*part.schema.names, "_one"])

    scored = texts.mapInArrow(work, f"{fields}, _one double")
    return from_probabilities(scored, F.array(1 - F.col("_one"), F.col("_one"))).drop("_one")


def quick_run(texts: DataFrame, validation: DataFrame, path: str, max_samples: int = 1000, config: TrainingConfig = TrainingConfig(),
              id_column: str = "doc_id") -> DataFrame:
    """Training on a repeatable sample of 100 to 10,000 labelled texts."""
    if not 100 <= max_samples <= 10_000:
        raise ValueError("a quick run takes 100 to 10000 samples")
    sample = shuffled_sample(texts.filter(F.col("label").isNotNull()), id_column, max_samples, config.seed)
    return train(sample, validation, path, config)


def search(texts: DataFrame, validation: DataFrame, path: str, grid: Sequence[dict], config: TrainingConfig = TrainingConfig()) -> DataFrame:
    """One run per setting of the grid over the same examples: (trial, setting..., best epoch's metrics, best)."""
    spark, made = texts.sparkSession, []
    for i, setting in enumerate(grid):
        if set(setting) & {"gram", "buckets", "batch_size"}:
            raise ValueError("a search shares its examples: n-grams and batch size are the same for all trials")
        own = replace(config, **setting)
        train(texts, validation, f"{path}/trial-{i}", own, prepared=f"{path}/data")
        best = best_checkpoint(checkpoints(spark, f"{path}/trial-{i}").withColumn("trial", F.lit(i)), ["trial"])
        made.append(best.withColumns({k: F.lit(asdict(own)[k]) for k in setting}))
    trials = made[0]
    for more in made[1:]:
        trials = trials.unionByName(more, allowMissingColumns=True)
    first = trials.agg(F.max_by("trial", F.struct("eval_f1", -F.col("trial")))).scalar()
    return trials.withColumn("best", F.col("trial") == first)
