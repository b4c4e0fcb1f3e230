"""Scores, batch prediction and evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numeric import argmax, softmax
from tallywatch.functions.vectors import text_runs
from tallywatch.operators.datasets import shuffled_sample
from tallywatch.operators.drift_text import TermWeights, add_terms

SCORED = pa.struct([("logits", pa.list_(pa.float64())), ("prediction_time", pa.float64())])


def sentiment(label: Column) -> Column:
    """POSITIVE for label 1, NEGATIVE otherwise."""
    return F.when(label == 1, "POSITIVE").otherwise("NEGATIVE")


def from_probabilities(df: DataFrame, probabilities: Column) -> DataFrame:
    """Add label, sentiment, confidence and the probabilities, the last two rounded to 4 digits."""
    label = argmax(F.col("_p"))
    return (
        df.withColumn("_p", probabilities)
        .withColumn("predicted_label", label)
        .withColumns(
            {
                "predicted_sentiment": sentiment(F.col("predicted_label")),
                "confidence_score": F.round(F.array_max("_p"), 4),
                "probabilities": F.transform("_p", lambda p: F.round(p, 4)),
            }
        )
        .drop("_p")
    )


def score_logits(df: DataFrame, logits: Sequence[str]) -> DataFrame:
    """Softmax over the logit columns; the lowest class wins ties."""
    return from_probabilities(df, softmax(F.array(*logits)))


def confusion(df: DataFrame, label: str = "label", predicted: str = "predicted_label") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(label, predicted).agg(F.count("*").alias("n"))


def weighted_metrics(
    df: DataFrame, keys: Sequence[str] = (), label: str = "label", predicted: str = "predicted_label", weight: str | None = None
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 per key; undefined ratios count as 0.

    All sums come from the confusion counts, so only the first aggregation sees rows. Unlabelled rows are left out, a
    missing prediction counts as wrong; predictions are not filtered on, which would compute them twice. A row counts as
    many times as its `weight` says.
    """
    scored = df.filter(F.col(label).isNotNull())
    counts = scored.groupBy(*keys, F.col(label).alias("_l"), F.col(predicted).alias("_p")).agg(
        (F.count("*") if weight is None else F.sum(weight)).alias("n")
    )
    hit = F.when(F.col("_l") == F.col("_p"), F.col("n")).otherwise(0)
    sides = counts.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("_l").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"), hit.alias("hits")),
                F.struct(F.col("_p").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("hits")),
            )
        ),
    )
    per_class = sides.groupBy(*keys, "cls").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits")
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    precision, recall = ratio(F.col("hits"), F.col("claimed")), ratio(F.col("hits"), F.col("support"))
    f1 = ratio(2 * precision * recall, precision + recall)
    total = F.sum("support")
    return per_class.groupBy(*keys).agg(
        total.alias("examples"),
        ratio(F.sum("hits"), total).alias("accuracy"),
        ratio(F.sum(F.col("support") * precision), total).alias("precision"),
        ratio(F.sum(F.col("support") * recall), total).alias("recall"),
        ratio(F.sum(F.col("support") * f1), total).alias("f1"),
    )


def evaluation_report(scored: DataFrame, config: dict[str, object], label: str = "label") -> DataFrame:
    """One row: overall metrics with the training configuration as JSON."""
    settings = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in config.items()]))
    return weighted_metrics(scored, label=label).withColumn("training_config", settings)


def text_features(df: DataFrame, column: str = "text") -> DataFrame:
    """Add `terms`: words without stop words, and their pairs."""
    return add_terms(df, column)


def _stages(weights: TermWeights, max_iter: int, reg_param: float) -> list:
    return [
        CountVectorizerModel.from_vocabulary(list(weights.terms), "terms", "counts"),
        ElementwiseProduct(scalingVec=Vectors.dense(weights.idf), inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter, regParam=reg_param),
    ]


def train_classifier(
    texts: DataFrame, max_samples: int | None = None, id_column: str = "doc_id", vocabulary_size: int = 1000,
    max_iter: int = 20, reg_param: float = 0.01, seed: int = 42,
) -> PipelineModel:
    """Two-class text classifier on the labelled texts; `max_samples` makes a quick run on a repeatable sample.

    The terms are counted with DataFrame aggregations; only the regression then iterates, over its own cached blocks.
    """
    labelled = texts.filter(F.col("label").isNotNull())
    if max_samples is not None:
        if not 100 <= max_samples <= 10_000:
            raise ValueError("a quick run takes 100 to 10000 samples")
        labelled = shuffled_sample(labelled, id_column, max_samples, seed)
    weights = TermWeights.fit(labelled, max_features=vocabulary_size)
    return Pipeline(stages=_stages(weights, max_iter, reg_param)).fit(text_features(labelled))


def search_classifier(
    texts: DataFrame, reg_params: Sequence[float] = (0.001, 0.01, 0.1), vocabulary_size: int = 1000, max_iter: int = 20,
    parallelism: int = 2, seed: int = 42,
) -> tuple[PipelineModel, list[tuple[float, float]]]:
    """Best classifier by weighted F1 over the regularisation strengths, with the F1 of each.

    The term vectors do not depend on the strength, so they are made once and only the regression is searched.
    """
    labelled = texts.filter(F.col("label").isNotNull())
    *features, regression = _stages(TermWeights.fit(labelled, max_features=vocabulary_size), max_iter, reg_params[0])
    search = TrainValidationSplit(
        estimator=regression,
        estimatorParamMaps=ParamGridBuilder().addGrid(regression.regParam, list(reg_params)).build(),
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        trainRatio=0.8,
        parallelism=parallelism,
        seed=seed,
    )
    vectors = PipelineModel(features).transform(text_features(labelled)).select("label", "features").persist()
    try:
        fitted = search.fit(vectors)
    finally:
        vectors.unpersist()
    return PipelineModel([*features, fitted.bestModel]), list(zip(reg_params, fitted.validationMetrics))


def score_texts(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Label, sentiment, confidence and probabilities of every text."""
    scored = model.transform(text_features(texts))
    added = ("terms", "counts", "features", "rawPrediction", "probability", "prediction")
    return from_probabilities(scored, vector_to_array("probability")).drop(*added)


def score_with(
    texts: DataFrame, load: Callable[[], Callable[[pd.Series], pd.DataFrame]], column: str = "text"
) -> DataFrame:
    """Score with any model: `load` runs once per task and returns a function from texts to class scores.

    The function gets a series of texts, some megabytes at most, and returns one column of logits per class. Only the texts go
    to the workers and only the scores come back.
    """

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import time

        predict = load()
        for texts in columns:
            made = [pa.array([], SCORED)]
            for rows, _, offsets in text_runs(texts):
                n, began = len(offsets) - 1, time.perf_counter()
                logits = list(predict(texts[rows].to_pandas()).to_numpy(dtype=float))
                spent = (time.perf_counter() - began) * 1000 / n
                made.append(pa.StructArray.from_arrays([pa.array(logits, SCORED["logits"].type, from_pandas=True), pa.array([spent] * n)], fields=list(SCORED)))
            pa.default_memory_pool().release_unused()  # a reused worker would keep what its largest batch took
            yield pa.concat_arrays(made)

    predicted = F.arrow_udf(run, "logits array<double>, prediction_time double").asNondeterministic()
    made = texts.withColumn("_scored", predicted(F.col(column).cast("string")))
    scored = made.select(*texts.columns, F.col("_scored.logits").alias("logits"), F.col("_scored.prediction_time").alias("prediction_time"))
    found = from_probabilities(scored, softmax(F.col("logits"))).drop("logits")
    return found.select(*texts.columns, "prediction_time", *[c for c in found.columns if c not in (*texts.columns, "prediction_time")])
