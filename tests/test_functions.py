from __future__ import annotations

import math
import random

import pandas as pd
import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tallywatch.functions import numeric, ordered, text
from tallywatch.functions.sizes import scratch_folder


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def test_stop_words_are_sparks_own(spark):
    assert list(text.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


@pytest.mark.parametrize("value", ["", " ", "a", " a  b\tc\nd ", "x y", " z　", "a\x1cb\x0bc\x85d", "é è"])
def test_word_count_and_strip_follow_python(spark, value):
    row = texts(spark, value).select(text.word_count(F.col("text")), text.strip(F.col("text"))).first()
    assert row[0] == len(value.split())
    assert row[1] == value.strip()


def test_terms_and_bigrams(spark):
    row = texts(spark, "The quick, brown fox: a b 12 x_y the Éte").select(
        text.with_bigrams(text.words_without_stops(F.col("text")))
    ).first()
    words = ["quick", "brown", "fox", "12", "x_y", "éte"]
    assert row[0] == words + [f"{a} {b}" for a, b in zip(words, words[1:])]


@pytest.mark.parametrize(("value", "expected"), [("", []), ("the a", []), ("word", ["word"])])
def test_short_texts_have_no_bigrams(spark, value, expected):
    assert texts(spark, value).select(text.with_bigrams(text.words_without_stops(F.col("text")))).first()[0] == expected


def test_padding_and_mask(spark):
    ids = F.array(*[F.lit(i) for i in (5, 6, 7)])
    row = one(spark, text.pad_ids(ids, 5), text.attention_mask(ids, 5), text.pad_ids(ids, 2), text.attention_mask(ids, 2))
    assert list(row) == [[5, 6, 7, 0, 0], [1, 1, 1, 0, 0], [5, 6], [1, 1]]


def test_preview(spark):
    row = one(spark, text.preview(F.lit("x" * 50)), text.preview(F.lit("x" * 51)))
    assert list(row) == ["x" * 50, "x" * 50 + "..."]


# two-sided critical values of the t distribution: (degrees of freedom, t, p)
@pytest.mark.parametrize(
    ("df", "t", "p"),
    [(1, 12.706, 0.05), (2, 4.303, 0.05), (3, 3.182, 0.05), (4, 2.776, 0.05), (5, 2.571, 0.05), (6, 3.707, 0.01), (28, 2.048, 0.05)],
)
def test_student_tail(spark, df, t, p):
    r = t / math.sqrt(df + t * t)
    assert one(spark, numeric.student_t_p(F.lit(r), F.lit(df + 2)))[0] == pytest.approx(p, abs=5e-5)  # the tables round t to three decimals


def test_student_tail_edges(spark):
    null = F.lit(None).cast("double")
    row = one(spark, numeric.student_t_p(F.lit(1.0), F.lit(5)), numeric.student_t_p(null, F.lit(5)), numeric.student_t_p(F.lit(0.0), F.lit(5)))
    assert list(row) == [0.0, 1.0, 1.0]


# the limiting distribution has its 5 % point at 1.3581 and its 1 % point at 1.6276
@pytest.mark.parametrize(("lam", "p"), [(1.3581, 0.05), (1.6276, 0.01), (0.1, 1.0)])
def test_kolmogorov_tail(spark, lam, p):
    n = 10_000
    d = lam / math.sqrt(n / 2)
    assert one(spark, numeric.kolmogorov_p(F.lit(d), F.lit(n), F.lit(n)))[0] == pytest.approx(p, abs=1e-5)


def test_softmax_and_argmax_take_the_lowest_class_on_ties(spark):
    p = numeric.softmax(F.array(F.lit(1000.0), F.lit(1000.0), F.lit(-1000.0)))
    row = one(spark, p, numeric.argmax(p))
    assert row[0] == [0.5, 0.5, 0.0] and row[1] == 0


def test_bands(spark):
    edges, names = (0.6, 0.8), ("critical", "warning", "healthy")
    values = [0.59, 0.6, 0.8, None]
    got = [one(spark, numeric.band(F.lit(v).cast("double"), edges, names))[0] for v in values]
    assert got == ["critical", "warning", "healthy", None]
    upto = [one(spark, numeric.band(F.lit(v), (100.0, 500.0), ("a", "b", "c"), inclusive_upper=True))[0] for v in (100.0, 500.0, 500.1)]
    assert upto == ["a", "b", "c"]


def skewed(spark, rows=3000, seed=1):
    """One key holds most rows."""
    rng = random.Random(seed)
    data = [(i, "hot" if rng.random() < 0.7 else rng.choice("abc"), rng.randrange(400), rng.randrange(-3, 5)) for i in range(rows)]
    return pd.DataFrame(data, columns=["id", "key", "at", "v"]), spark.createDataFrame(data, "id int, key string, at int, v int")


def test_running_totals_equal_one_sorted_pass(spark):
    pdf, df = skewed(spark)
    got = ordered.running_totals(df, ["key"], [F.col("at"), F.col("id")], ["v"], F.floor(F.col("at") / 37), with_totals=True)
    expected = pdf.sort_values(["at", "id"]).assign(total=lambda x: x.groupby("key")["v"].transform("sum"))
    expected["v"] = expected.groupby("key")["v"].cumsum()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected[["id", "key", "at", "v", "total"]].itertuples(index=False)}


def test_running_totals_without_keys_and_with_null_key(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 9, 2), ("x", 5, 4)], "key string, at int, v int")
    plain = ordered.running_totals(df, [], [F.col("at")], ["v"], F.floor(F.col("at") / 4)).orderBy("at")
    assert [r.v for r in plain.collect()] == [1, 5, 7]
    keyed = ordered.running_totals(df, ["key"], [F.col("at")], ["v"], F.floor(F.col("at") / 4)).orderBy("at")
    assert [r.v for r in keyed.collect()] == [1, 4, 3]


def test_previous_row_equals_lag(spark):
    pdf, df = skewed(spark, seed=2)
    got = ordered.previous_row(df, ["key"], ["at", "id"], {"before": "v"}, F.floor(F.col("at") / 11)).select("id", "before")
    expected = pdf.sort_values(["at", "id"])
    expected["before"] = expected.groupby("key")["v"].shift(1)
    assert {r.id: r.before for r in got.collect()} == {
        i: None if pd.isna(b) else int(b) for i, b in zip(expected["id"], expected["before"])
    }


def test_exact_quantiles_equal_pandas(spark):
    pdf, df = skewed(spark, seed=3)
    counts = df.groupBy("key", F.col("at").cast("double").alias("value")).agg(F.count("*").alias("n"))
    bounds = ordered.value_bounds(df, ["at"], 8)["at"]
    got = ordered.exact_quantiles(counts, ["key"], "value", "n", {"p50": 0.5, "p99": 0.99}, ordered.bucket_of(F.col("value"), bounds))
    for row in got.collect():
        values = pdf[pdf["key"] == row.key]["at"]
        assert row.p50 == pytest.approx(values.quantile(0.5)) and row.p99 == pytest.approx(values.quantile(0.99))


class Session:
    """Stands in for a session with a given shared folder and master."""

    def __init__(self, shared, master):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_is_the_shared_one_on_a_cluster():
    assert scratch_folder(Session("hdfs://x/tmp/", "yarn"), "log").startswith("hdfs://x/tmp/log-")
    assert "tallywatch-" in scratch_folder(Session(None, "local[2]"), "log")
    with pytest.raises(ValueError):
        scratch_folder(Session(None, "spark://host:7077"), "log")


def test_bucket_is_the_number_of_cuts_below(spark):
    from bisect import bisect_left

    from tallywatch.functions.ordered import bucket_of

    values = [None, float("nan"), -1.0, 0.0, 0.5, 1.0, 3.0, 3.5, 7.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    for cuts in ([], [3.0], [0.0, 1.0, 3.0], [float(i) for i in range(17)]):
        got = [r.b for r in df.select(bucket_of(F.col("v"), cuts).alias("b")).collect()]
        assert got == [0 if v is None else len(cuts) if v != v else bisect_left(cuts, v) for v in values]
