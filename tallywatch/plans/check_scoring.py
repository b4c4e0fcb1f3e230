"""Checked queries for scoring, training and evaluation, and for user functions."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.functions.sizes import scratch_folder
from tallywatch.functions.text import tokens
from tallywatch.operators import batches, scoring, training
from tallywatch.plans.check_texts import TOKENS
from tallywatch.plans.registry import query, settled
from tallywatch.sources.canonical import Tables


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


WEIGHTED = """WITH s AS (SELECT {key} AS split, label, predicted_label FROM labelled_texts WHERE label IS NOT NULL),
  k AS (SELECT DISTINCT split, label AS c FROM s UNION SELECT DISTINCT split, predicted_label FROM s),
  m AS (SELECT k.split, c, count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE predicted_label = c) AS claimed,
    count(*) FILTER (WHERE label = c AND predicted_label = c) AS hits FROM k JOIN s ON s.split = k.split GROUP BY 1, 2),
  r AS (SELECT *, coalesce(hits / CAST(nullif(claimed, 0) AS DOUBLE), 0) AS p,
    coalesce(hits / CAST(nullif(support, 0) AS DOUBLE), 0) AS q FROM m),
  f AS (SELECT *, coalesce(2 * p * q / nullif(p + q, 0), 0) AS f1 FROM r),
  w AS (SELECT split, CAST(sum(support) AS BIGINT) AS examples, sum(hits) / CAST(sum(support) AS DOUBLE) AS accuracy,
    sum(support * p) / CAST(sum(support) AS DOUBLE) AS precision, sum(support * q) / CAST(sum(support) AS DOUBLE) AS recall,
    sum(support * f1) / CAST(sum(support) AS DOUBLE) AS f1 FROM f GROUP BY 1)"""
METRICS = f"""{settled("accuracy")} AS accuracy, {settled("precision")} AS precision, {settled("recall")} AS recall,
  {settled("f1")} AS f1"""


@query(
    "A23_weighted_metrics",
    "labelled_texts",
    f"{WEIGHTED.format(key='split')} SELECT split, examples, {METRICS} FROM w",
)
def _(t: Tables):
    return _settle(scoring.weighted_metrics(t.labelled_texts, ["split"]), "accuracy", "precision", "recall", "f1")


@query(
    "A23_confusion_matrix",
    "labelled_texts",
    "SELECT label, predicted_label, count(*) AS n FROM labelled_texts GROUP BY 1, 2",
)
def _(t: Tables):
    return scoring.confusion(t.labelled_texts)


CONFIG = {"model_name": "length-rule", "epochs": 3, "learning_rate": 2e-05, "batch_size": 16}


@query(
    "G17_evaluation_report",
    "labelled_texts",
    f"""{WEIGHTED.format(key="'all'")} SELECT examples, {METRICS},
      '{{"model_name":"length-rule","epochs":3,"learning_rate":2.0E-5,"batch_size":16}}' AS training_config FROM w""",
)
def _(t: Tables):
    return _settle(scoring.evaluation_report(t.labelled_texts, CONFIG), "accuracy", "precision", "recall", "f1")


def _split(t: Tables, *names: str):
    return t.labelled_texts.filter(F.col("split").isin(*names))


@query("G14_batch_scores")
def _(t: Tables):
    model = scoring.train_classifier(_split(t, "train"))
    scored = scoring.score_texts(model, t.labelled_texts.drop("predicted_label"))
    return scored.select("doc_id", "split", "predicted_label", "predicted_sentiment", "confidence_score", "probabilities")


@query(
    "G14_external_model_scores",
    "",
    """WITH z AS (SELECT doc_id, 1 / (1 + exp(-2 * (ln(1 + length(text)) - 7))) AS p FROM documents)
    SELECT doc_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted_label,
      CASE WHEN p > 0.5 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS predicted_sentiment,
      round(greatest(p, 1 - p), 4) AS confidence_score, round(1 - p, 4) AS negative, round(p, 4) AS positive FROM z""",
)
def _(t: Tables):
    def load():
        import numpy as np
        import pandas as pd

        def predict(texts):
            sizes = np.log1p(texts.str.len().to_numpy(dtype=float))
            return pd.DataFrame({"negative": 7.0 - sizes, "positive": sizes - 7.0})

        return predict

    scored = scoring.score_with(t.documents.select("doc_id", "text"), load)
    return scored.select(
        "doc_id", "predicted_label", "predicted_sentiment", "confidence_score",
        F.col("probabilities")[0].alias("negative"), F.col("probabilities")[1].alias("positive"),
    )


@query("G15_trained_classifier")
def _(t: Tables):
    model = scoring.train_classifier(_split(t, "train"))
    scored = scoring.score_texts(model, _split(t, "validation", "test").drop("predicted_label"))
    return scoring.weighted_metrics(scored, ["split"])


@query("G16_hyper_parameter_search")
def _(t: Tables):
    model, tried = scoring.search_classifier(_split(t, "train"))
    best = scoring.weighted_metrics(scoring.score_texts(model, _split(t, "test").drop("predicted_label")))
    trials = F.array(*[F.struct(F.lit(float(p)).alias("reg_param"), F.lit(float(f)).alias("validation_f1")) for p, f in tried])
    return best.select("examples", "accuracy", "f1", F.inline(trials))


@query("G18_quick_run")
def _(t: Tables):
    model = scoring.train_classifier(_split(t, "train"), max_samples=1000)
    return scoring.weighted_metrics(scoring.score_texts(model, _split(t, "test").drop("predicted_label")))


# a model must do better than always giving the most frequent class, whose weighted F1 is share * 2 * share / (1 + share)
MAJORITY = f"""WITH n AS (SELECT split, label, count(*) AS n FROM labelled_texts WHERE label IS NOT NULL AND split IN ({{splits}}) GROUP BY 1, 2),
  m AS (SELECT split, CAST(sum(n) AS BIGINT) AS examples, max(n) / CAST(sum(n) AS DOUBLE) AS share FROM n GROUP BY 1),
  b AS (SELECT split, examples, {settled("share * 2 * share / (1 + share)")} AS majority_f1 FROM m)"""
EPOCHS = training.TrainingConfig(epochs=5, batch_size=64)
GRID = [{"learning_rate": 0.02}, {"learning_rate": 0.05}, {"learning_rate": 0.05, "weight_decay": 0.1}]


def _against_majority(scored):
    """Per split: examples, F1 of the most frequent class, and whether the model's is higher."""
    n = scored.filter(F.col("label").isNotNull()).groupBy("split", "label").agg(F.count("*").alias("n"))
    share = F.max("n") / F.sum("n").cast("double")
    plain = n.groupBy("split").agg(F.sum("n").alias("examples"), share.alias("share"))
    plain = plain.withColumn("majority_f1", settle(F.col("share") * 2 * F.col("share") / (1 + F.col("share"))))
    found = scoring.weighted_metrics(scored, ["split"]).select("split", "f1")
    return plain.join(found, "split").select("split", "examples", "majority_f1", (F.col("f1") > F.col("majority_f1")).alias("beats_majority"))


def _sides(t: Tables):
    texts = t.labelled_texts.drop("predicted_label")
    return texts.filter("split = 'train'"), texts.filter("split = 'validation'"), texts.filter("split <> 'train'")


@query(
    "G15_training_epochs",
    "labelled_texts",
    """SELECT CAST(e AS INT) AS epoch, CAST(e * ceil((SELECT count(*) FROM labelled_texts WHERE label IS NOT NULL AND split = 'train') / 64.0) AS BIGINT) AS step,
      true AS loss_fell FROM range(1, 6) r(e)""",
)
def _(t: Tables):
    train, validation, _ = _sides(t)
    path = scratch_folder(t.spark, "training")
    training.train(train, validation, path, EPOCHS, until=2)
    done = training.train(train, validation, path, EPOCHS)  # goes on from the second epoch's checkpoint
    before = F.coalesce(F.lag("train_loss").over(Window.orderBy("epoch")), F.lit(math.log(2)))  # one row per epoch
    return done.select("epoch", "step", (F.col("train_loss") < before).alias("loss_fell"))


@query("G15_trained_evaluation", "labelled_texts", MAJORITY.format(splits="'validation', 'test'") + " SELECT *, true AS beats_majority FROM b")
def _(t: Tables):
    train, validation, held = _sides(t)
    path = scratch_folder(t.spark, "training")
    training.train(train, validation, path, EPOCHS)
    return _against_majority(training.score(training.load(t.spark, path, EPOCHS), held))


@query(
    "G16_searched_evaluation",
    "labelled_texts",
    MAJORITY.format(splits="'test'") + """, t(trial, learning_rate, weight_decay) AS (VALUES (0, 0.02, 0.01), (1, 0.05, 0.01), (2, 0.05, 0.1))
    SELECT CAST(trial AS INT) AS trial, CAST(learning_rate AS DOUBLE) AS learning_rate, CAST(weight_decay AS DOUBLE) AS weight_decay,
      examples, majority_f1, true AS best_beats_majority FROM t, b""",
)
def _(t: Tables):
    train, validation, held = _sides(t)
    path, config = scratch_folder(t.spark, "search"), replace(EPOCHS, epochs=3)
    trials = training.search(train, validation, path, GRID, config)
    best = trials.filter("best").first()["trial"]
    test = _against_majority(training.score(training.load(t.spark, f"{path}/trial-{best}", config), held.filter("split = 'test'")))
    rates = trials.select("trial", "learning_rate", F.coalesce("weight_decay", F.lit(config.weight_decay)).alias("weight_decay"))
    of_best = test.withColumnRenamed("beats_majority", "best_beats_majority").drop("split").first().asDict()
    return rates.withColumns({name: F.lit(value) for name, value in of_best.items()}).withColumn("examples", F.col("examples").cast("bigint"))


@query("G18_quick_run_evaluation", "labelled_texts", MAJORITY.format(splits="'test'") + " SELECT *, true AS beats_majority FROM b")
def _(t: Tables):
    train, validation, held = _sides(t)
    path = scratch_folder(t.spark, "quick-run")
    training.quick_run(train, validation, path, config=EPOCHS)
    return _against_majority(training.score(training.load(t.spark, path, EPOCHS), held.filter("split = 'test'")))


@query(
    "F1_batched_map",
    "",
    "SELECT doc_id, CAST(length(text) AS BIGINT) AS characters, lang || '-' || source AS origin FROM documents",
)
def _(t: Tables):
    def measure(batch):
        return batch.assign(characters=batch["text"].str.len(), origin=batch["lang"] + "-" + batch["source"])[
            ["doc_id", "characters", "origin"]
        ]

    return batches.map_batches(t.documents, measure, "doc_id long, characters long, origin string", ["n_chars"])


@query(
    "F2_metric_callback",
    "labelled_texts",
    f"""SELECT split, {settled("count(*) FILTER (WHERE label = predicted_label) / CAST(count(*) AS DOUBLE)")} AS accuracy,
      {settled("count(*) FILTER (WHERE label <> predicted_label) / CAST(count(*) AS DOUBLE)")} AS error
    FROM labelled_texts WHERE label IS NOT NULL GROUP BY 1""",
)
def _(t: Tables):
    def metric(labels, predictions, weights):
        right = weights[labels == predictions].sum() / weights.sum()
        return {"accuracy": right, "error": 1 - right}

    return _settle(batches.metric_callback(t.labelled_texts, metric, ["accuracy", "error"], ["split"]), "accuracy", "error")


@query(
    "F3_token_rows",
    "",
    f"""WITH x AS (SELECT conv_id, turn, {TOKENS} AS toks FROM conversations)
    SELECT conv_id, turn, unnest(range(len(toks))) AS position, unnest(toks) AS token FROM x""",
)
def _(t: Tables):
    rows = t.raw("conversations").select("conv_id", "turn", F.posexplode(tokens(F.col("text"))).alias("position", "token"))
    return rows.withColumn("position", F.col("position").cast("bigint"))
