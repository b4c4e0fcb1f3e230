"""Dataset metrics history, splits and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.numeric import truthy
from tallywatch.functions.text import word_count

QUALITY_SCORES = ("quality_score", "completeness_score", "consistency_score", "validity_score")


def latest_metrics(metrics: DataFrame, keys: Sequence[str] = ("dataset_name", "split_name")) -> DataFrame:
    """The newest metrics row per dataset and split."""
    others = [c for c in metrics.columns if c not in keys]
    last = metrics.groupBy(*keys).agg(F.max_by(F.struct(*others), "computed_at").alias("last"))
    return last.select(*keys, "last.*")


def drift_history(metrics: DataFrame, since: Column) -> DataFrame:
    """Rows with a drift score at or after a moment, oldest first."""
    kept = metrics.filter(F.col("drift_score").isNotNull() & (F.col("computed_at") >= since))
    return kept.orderBy("computed_at", "dataset_name", "split_name")


def quality_degradation(metrics: DataFrame, threshold: float = 0.1, mode: str = "dataset") -> DataFrame:
    """Scores that fell by more than `threshold` between a dataset's two newest rows.

    `mode="dataset"` compares rows of any split, `mode="split"` only rows of the same split. Scores that are NULL or 0
    on either side are left out.
    """
    keys = {"dataset": ["dataset_name"], "split": ["dataset_name", "split_name"]}[mode]
    order = Window.partitionBy(*keys).orderBy(F.col("computed_at").desc(), F.col("split_name"))
    # the rank filter is pushed below the shuffle, so a task receives two rows per key and sender
    two = metrics.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 2)
    pick = {rank: F.max_by(F.struct("computed_at", *QUALITY_SCORES), F.when(F.col("rank") == rank, 1)) for rank in (1, 2)}
    pairs = two.groupBy(*keys).agg(pick[1].alias("current"), pick[2].alias("previous"))
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                truthy(F.col(f"current.{m}")).alias("current_value"),
                truthy(F.col(f"previous.{m}")).alias("previous_value"),
            )
            for m in QUALITY_SCORES
        ]
    )
    long = pairs.select(*keys, F.col("current.computed_at").alias("computed_at"), F.inline(rows))
    fall = F.col("previous_value") - F.col("current_value")
    return long.withColumn("degradation", fall).filter(F.col("degradation") > threshold)


def split_statistics(texts: DataFrame) -> DataFrame:
    """Per split: examples, and mean, least and greatest word count."""
    words = word_count(F.col("text"))
    return texts.groupBy("split").agg(
        F.count("*").alias("num_examples"),
        F.avg(words).alias("avg_length"),
        F.min(words).alias("min_length"),
        F.max(words).alias("max_length"),
    )


def statistics_as_metrics(texts: DataFrame) -> DataFrame:
    """The split statistics and label counts as (metric, value) rows with the total over all splits."""
    words = texts.withColumn("_words", word_count(F.col("text")))
    named = F.concat_ws("_", F.col("split"), F.lit("label"), F.col("label"), F.lit("count"))
    counted = words.groupingSets([[F.col("split")], [F.col("split"), F.col("label")], []], "split", "label").agg(
        F.count("*").cast("double").alias("n"),
        F.avg("_words").alias("avg_length"),
        F.min("_words").cast("double").alias("min_length"),
        F.max("_words").cast("double").alias("max_length"),
        F.grouping_id().alias("gid"),
    )

    def metric(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metric"), value.alias("value"))

    of_split = F.array(
        *[
            metric(F.concat_ws("_", F.col("split"), F.lit(suffix)), F.col(value))
            for suffix, value in (
                ("num_examples", "n"),
                ("avg_text_length", "avg_length"),
                ("min_text_length", "min_length"),
                ("max_text_length", "max_length"),
            )
        ]
    )
    rows = (
        F.when(F.col("gid") == 1, of_split)
        .when(F.col("gid") == 3, F.array(metric(F.lit("total_examples"), F.col("n"))))
        .when(F.col("label").isNotNull(), F.array(metric(named, F.col("n"))))
    )
    return counted.select(F.inline(rows))


def shuffle_key(id_column: str, seed: int) -> Column:
    """A text that orders rows pseudo-randomly and repeatably."""
    return F.md5(F.concat_ws("-", F.col(id_column).cast("string"), F.lit(str(seed))))


def stratified_split(
    df: DataFrame, id_column: str, label: str | None = "label", test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `split`: exactly ceil(test_size * n) rows of every label go to validation, the others to train.

    The rows of a label are ordered by a hash. Counts per (label, first four hash digits) find the digit group in which
    the quota ends; only that group's rows, about one in 65536, are ranked to find the exact cut. The texts are then
    labelled in place by comparing with their label's cut, without a shuffle. NULL is a label of its own.
    """
    stratum = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")) if label else F.lit("")
    place = F.struct(shuffle_key(id_column, seed).alias("key"), F.col(id_column).alias("id"))
    keyed = df.select(stratum.alias("_stratum"), place.alias("_place")).withColumn(
        "_group", F.substring("_place.key", 1, 4)
    )
    counts = keyed.groupBy("_stratum", "_group").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("_stratum")
    earlier = whole.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    quota = counts.select(
        "_stratum",
        "_group",
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.ceil(F.lit(float(test_size)) * F.sum("n").over(whole)).alias("quota"),
    )
    edge = quota.filter((F.col("before") < F.col("quota")) & (F.col("before") + F.col("n") >= F.col("quota"))).select(
        "_stratum", "_group", (F.col("quota") - F.col("before")).alias("left")
    )
    in_edge = keyed.join(edge, ["_stratum", "_group"])
    rank = F.row_number().over(whole.orderBy("_place"))
    cut = in_edge.withColumn("rank", rank).filter(F.col("rank") == F.col("left")).select(
        "_stratum", F.col("_place").alias("_cut")
    )
    joined = df.withColumn("_stratum", stratum).join(cut, "_stratum", "left")
    side = F.when(place <= F.col("_cut"), "validation").otherwise("train")
    return joined.withColumn("split", side).drop("_stratum", "_cut")


def with_validation(
    df: DataFrame, id_column: str, label: str | None = "label", validation_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Carve a validation split out of train, only when there is none yet and the fraction is above 0."""
    if validation_size <= 0 or not df.filter(F.col("split") == "validation").limit(1).isEmpty():
        return df
    train = df.filter(F.col("split") == "train").drop("split")
    return stratified_split(train, id_column, label, validation_size, seed).unionByName(df.filter(F.col("split") != "train"))


def shuffled_sample(df: DataFrame, id_column: str, n: int, seed: int = 42) -> DataFrame:
    """The first `n` rows of a repeatable shuffle."""
    return df.orderBy(shuffle_key(id_column, seed), F.col(id_column)).limit(n)


def reference_texts(texts: DataFrame) -> DataFrame:
    """All texts of the validation split, or of train when there is no validation split."""
    has_validation = not texts.filter(F.col("split") == "validation").limit(1).isEmpty()
    return texts.filter(F.col("split") == ("validation" if has_validation else "train"))


def reference_sample(texts: DataFrame, n: int, id_column: str = "doc_id") -> DataFrame:
    """The first `n` reference texts by id."""
    return reference_texts(texts).orderBy(id_column).limit(n)
