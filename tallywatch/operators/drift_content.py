"""Drift of what texts say: can a classifier tell current texts from reference texts?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numeric import share
from tallywatch.functions.ordered import bucket_of, running_totals, value_bounds
from tallywatch.functions.sizes import pieces_of
from tallywatch.operators.training import TrainingConfig, load, score, train

DOMAIN = TrainingConfig(epochs=2, batch_size=512)
TOLD_APART = 0.55


def area_under_curve(scored: DataFrame, keys: Sequence[str] = (), label: str = "label", value: str = "score", pieces: int | None = None) -> DataFrame:
    """Probability that a row of label 1 scores above one of label 0, equal scores counting half: (keys, n_ref, n_cur, auc).

    From rank sums: rows are counted per score, and each score's rows of label 1 are above those of label 0 that the running
    total has below. Totals run inside pieces of the scores. Rows without score or label are left out; NULL without both sides.
    """
    rows = scored.filter(F.col(value).isNotNull() & F.col(label).isin(0, 1))
    counts = rows.groupBy(*keys, F.col(value).cast("double").alias("_value")).agg(
        F.count_if(F.col(label) == 0).alias("_zero"), F.count_if(F.col(label) == 1).alias("_one")
    )
    bounds = value_bounds(rows.select(F.col(value).cast("double").alias("_value")), ["_value"], pieces or pieces_of(scored.sparkSession))["_value"]
    totals = running_totals(
        counts.withColumn("_below", F.col("_zero")), list(keys), [F.col("_value")], ["_below"], bucket_of(F.col("_value"), bounds)
    )
    won = F.sum(F.col("_one") * (F.col("_below") - F.col("_zero") / 2))
    pairs = F.sum("_zero").cast("double") * F.sum("_one")
    return totals.groupBy(*keys).agg(F.sum("_zero").alias("n_ref"), F.sum("_one").alias("n_cur"), share(won, pairs).alias("auc"))


def content_drift(
    reference: DataFrame, current: DataFrame, path: str, column: str = "text", config: TrainingConfig = DOMAIN, threshold: float = TOLD_APART
) -> DataFrame:
    """One row: held-out texts of both sides, the area under the curve, and whether it is above `threshold`.

    A text belongs to the half that is learned from or to the held-out one by a hash of itself, so equal texts are never in
    both. Equal sides come to about 0.5, whatever the classifier learns.
    """

    def side(df: DataFrame, label: int) -> DataFrame:
        return df.select(F.coalesce(F.col(column), F.lit("")).alias("text"), F.lit(label).alias("label"))

    both = side(reference, 0).unionByName(side(current, 1)).withColumn("held", F.pmod(F.xxhash64("text", F.lit(config.seed)), F.lit(2)) == 1)
    learned, held = both.filter(~F.col("held")), both.filter("held")
    # no checkpoint is chosen by the held-out half: the last epoch is taken
    train(learned, learned, path, config)
    model = load(reference.sparkSession, path, config, metric="epoch")
    scored = score(model, held.select("text", "label")).withColumn("score", F.col("probabilities")[1])
    found = area_under_curve(scored)
    return found.withColumn("drift_detected", F.coalesce(F.col("auc") > threshold, F.lit(False)))
