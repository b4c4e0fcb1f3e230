"""Text drift: TF-IDF centroids and text lengths against a reference."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.sizes import stored
from tallywatch.functions.text import ENGLISH_STOP_WORDS, TERM_CHARACTER, WHITESPACE, marked_characters, with_bigrams, words_without_stops
from tallywatch.functions.vectors import RUN_VALUES, counted, list_runs, lists, long_runs, lower_cased, of_kind, runs_of, term_counts, text_runs, unit_length
from tallywatch.operators.drift_stats import ks_two_sample

MAX_FEATURES = 1000
FREQUENT_WORDS = 10_000  # words that a plan may name
SUM_CELLS = 1 << 22  # numbers that a task keeps before it passes its sums on


def add_terms(df: DataFrame, column: str, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, output: str = "terms") -> DataFrame:
    """Add the words and word pairs of a text; the words are a column of their own, so they are extracted once."""
    words = df.withColumn("_words", words_without_stops(F.col(column), stop_words))
    return words.withColumn(output, with_bigrams(F.col("_words"))).drop("_words")


def add_terms_of(df: DataFrame, column: str, words: Sequence[str], stop_words: Sequence[str] = ENGLISH_STOP_WORDS, output: str = "terms") -> DataFrame:
    """Add those terms of `add_terms` that consist of the given words alone."""
    marked = F.transform(words_without_stops(F.col(column), stop_words), lambda word: F.when(word.isin(list(words)), word))
    return df.withColumn("_words", marked).withColumn(output, F.array_compact(with_bigrams(F.col("_words")))).drop("_words")


def frequent_words(texts: DataFrame, column: str, n: int, stop_words: Sequence[str]) -> list[str] | None:
    """Words at least as frequent as the `n`-th one; None where they are too many to be named."""
    each = texts.select(F.explode(words_without_stops(F.col(column), stop_words)).alias("word"))
    top = each.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.col("n").desc()).limit(FREQUENT_WORDS + 1).collect()
    least = top[n - 1]["n"] if len(top) >= n > 0 else 0
    words = [r["word"] for r in top if r["n"] >= least]
    return words if len(words) <= FREQUENT_WORDS else None


def fit_terms(
    texts: DataFrame, column: str = "text", max_features: int = MAX_FEATURES, stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """The most frequent terms of the texts with corpus count, document frequency and smoothed idf.

    The terms of a text are sorted in place, so its first occurrences mark document frequency and one aggregation with
    partial sums counts both; no (text, term) pairs are shuffled. Every text adds one NULL term, whose count is the
    number of texts. Equal counts are cut alphabetically.

    Words are counted first: a pair is at most as frequent as its words, so only words and pairs of words that reach the
    count of the last word within `max_features` can be among the terms, and a task never counts all pairs. Where too many words
    reach it (most occur once), all terms are counted.
    """
    nothing = F.array(F.lit(None).cast("string"))
    words = frequent_words(texts, column, max_features, stop_words)
    terms = add_terms(texts.select(column), column, stop_words) if words is None else add_terms_of(texts.select(column), column, words, stop_words)
    ordered = terms.select(F.concat(nothing, F.sort_array("terms")).alias("term"))
    shifted = ordered.withColumn("before", F.concat(nothing, F.slice("term", 1, F.size("term") - 1)))
    counted = (
        shifted.select(F.inline(F.arrays_zip("term", "before")))
        .groupBy("term")
        .agg(
            F.count("*").alias("corpus_count"),
            F.count_if(~F.col("term").eqNullSafe(F.col("before"))).alias("document_count"),
        )
    )
    order = [F.col("term").isNull().desc(), F.col("corpus_count").desc(), F.col("term")]
    top = counted.orderBy(*order).limit(max_features + 1)
    n_texts = F.max(F.when(F.col("term").isNull(), F.col("corpus_count"))).over(Window.partitionBy())
    idf = F.log((1.0 + n_texts) / (1.0 + F.col("document_count"))) + 1.0
    return top.withColumn("idf", idf).filter(F.col("term").isNotNull())


@dataclass(frozen=True)
class TermWeights:
    """Fitted terms and their idf: at most `max_features` of each, fetched once."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS

    @classmethod
    def fit(cls, texts: DataFrame, column: str = "text", max_features: int = MAX_FEATURES,
            stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> TermWeights:
        table = fit_terms(texts, column, max_features, stop_words).select("term", "idf").orderBy("term").toArrow()
        return cls(tuple(table["term"].to_pylist()), tuple(table["idf"].to_pylist()), tuple(stop_words))

    def add_known(self, texts: DataFrame, column: str, output: str = "_terms") -> DataFrame:
        """Add the terms of a text that can be fitted ones: those of words that occur in fitted terms."""
        return add_terms_of(texts, column, sorted({w for term in self.terms for w in term.split(" ")}), self.stop_words, output)

    def transform(self, texts: DataFrame, column: str = "text", output: str = "tfidf") -> DataFrame:
        """Add the unit-length TF-IDF vector of each text, in the task that reads it; unknown terms are dropped."""
        if not self.terms:
            raise ValueError("the reference texts hold no terms")
        counted = CountVectorizerModel.from_vocabulary(list(self.terms), "_terms", "_counts").transform(self.add_known(texts, column))
        weighted = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weighted")
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        return unit.transform(weighted.transform(counted)).drop("_terms", "_counts", "_weighted")

    def centroids(self, texts: DataFrame, keys: Sequence[str] = (), column: str = "text") -> DataFrame:
        """Mean vector per key over all its texts, those without a known term included: one short array per key."""
        vectors = self.transform(texts.select(*keys, column), column)
        return vectors.groupBy(*keys).agg(
            vector_to_array(Summarizer.mean(F.col("tfidf"))).alias("centroid"), F.count("*").alias("texts")
        )


@dataclass(frozen=True)
class KnownTerms:
    """Fitted terms found in the bytes of lower-cased texts; as `add_known`, where texts are read."""

    weights: TermWeights
    letters: np.ndarray
    spaces: np.ndarray

    @classmethod
    def of(cls, weights: TermWeights, spark: SparkSession) -> KnownTerms:
        return cls(weights, marked_characters(spark, TERM_CHARACTER), marked_characters(spark, f"[{WHITESPACE}]"))

    def reader(self) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """A function of some texts' bytes and offsets: (text, place, weight) of the unit-length vectors, and words per text."""
        letters, spaces = np.unpackbits(self.letters).astype(bool), np.unpackbits(self.spaces).astype(bool)
        stops, split, idf = dict.fromkeys(self.weights.stop_words), [t.split(" ") for t in self.weights.terms], np.array(self.weights.idf)
        words = dict.fromkeys([*stops, *sorted({w for parts in split for w in parts})])
        number, known = {w: i for i, w in enumerate(words)}, pa.array(list(words), pa.large_string())
        single = np.full(len(words) + 1, -1)
        pairs = {}
        for place, parts in reversed(list(enumerate(split))):
            if len(parts) == 1:
                single[number[parts[0]]] = place
            elif len(parts) == 2:
                pairs[number[parts[0]] * len(words) + number[parts[1]]] = place
        pair_key = np.array(sorted(pairs), dtype=np.int64)
        pair_place = np.array([pairs[k] for k in pair_key.tolist()], dtype=np.int64)

        def read(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            n = len(offsets) - 1
            begin = runs_of(~of_kind(data, spaces), offsets)[0]
            n_words = np.diff(np.searchsorted(begin, offsets))
            found, row = long_runs(data, offsets, letters, 2)
            code = np.asarray(pc.fill_null(pc.index_in(found, value_set=known), len(words))).astype(np.int64)
            stay = code >= len(stops)
            code, row = code[stay], row[stay]
            alone = single[code]
            whole = (row[1:] == row[:-1]) & (code[1:] < len(words)) & (code[:-1] < len(words))
            key, pair_row = (code[:-1] * len(words) + code[1:])[whole], row[1:][whole]
            at = np.searchsorted(pair_key, key)
            hit = np.append(pair_key, -1)[at] == key
            rows = np.concatenate([row[alone >= 0], pair_row[hit]])
            places = np.concatenate([alone[alone >= 0], pair_place[at[hit]]])
            row, place, count = counted(rows, places, len(idf))
            return row, place, unit_length(row, count * idf[place], n), n_words

        return read


class KeptSums:
    """Sums per group and place, and counts per group and length, of what a task has read so far."""

    def __init__(self, n_terms: int):
        self.n_terms, self.room = n_terms, max(1, SUM_CELLS // n_terms)
        self.clear()

    def clear(self) -> None:
        self.groups: dict[tuple, int] = {}
        self.sums = np.zeros(self.room * self.n_terms)  # the system gives memory as it is written
        self.lengths: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add_lengths(self, group: np.ndarray, words: np.ndarray, count: np.ndarray) -> None:
        self.lengths.append((group, words, count))
        self.pending += len(group)
        if self.pending > SUM_CELLS // 4:
            self.lengths = [self._merged()]
            self.pending = len(self.lengths[0][0])

    def _merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group, words, count = (np.concatenate(parts) for parts in zip(*self.lengths))
        size = int(words.max(initial=0)) + 1
        cells, cell = np.unique(group * size + words, return_inverse=True)
        return cells // size, cells % size, np.bincount(cell, count, minlength=len(cells)).astype(np.float64)

    def rows(self) -> Iterator[tuple[list[tuple], str, pa.Array, pa.Array]]:
        """Groups, kind, places and values, some groups at a time."""
        groups, step = list(self.groups), max(1, RUN_VALUES // self.n_terms)
        for at in range(0, len(groups), step):
            part = self.sums[at * self.n_terms : min(at + step, len(groups)) * self.n_terms]
            cell = np.flatnonzero(part)
            n = min(step, len(groups) - at)
            yield groups[at : at + n], "weight", lists(cell // self.n_terms, (cell % self.n_terms).astype(np.int32), n), lists(cell // self.n_terms, part[cell], n)
        if groups:
            group, words, count = self._merged()
            yield groups, "length", lists(group, words.astype(np.int32), len(groups)), lists(group, count, len(groups))


def text_sums(weights: TermWeights, texts: DataFrame, keys: Sequence[str] = (), column: str = "text") -> DataFrame:
    """What drift needs of texts, in one pass and ready to be added up: (keys, kind, place, x).

    Kind `weight` holds the summed unit-length TF-IDF weight of each fitted term (its place), kind `length` the number of texts
    with so many words (the place). A task sums all it reads per key, and only those sums are shuffled, a list per key and kind;
    equal texts that it reads together are looked into once. Rows of any parts of a table add up to those of the whole.
    """
    if not weights.terms:
        raise ValueError("the reference texts hold no terms")
    names = [f"_k{i}" for i in range(len(keys))]
    narrow = texts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(column).alias("_text"))
    terms, types = KnownTerms.of(weights, texts.sparkSession), [texts.schema[k].dataType for k in keys]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, kept, schema = terms.reader(), KeptSums(len(weights.terms)), None

        def given() -> Iterator[pa.RecordBatch]:
            for groups, kind, places, values in kept.rows():
                own = [pa.array([g[i] for g in groups], schema.field(n).type) for i, n in enumerate(names)]
                own += [pa.array([kind] * len(groups), pa.string()), places, values]
                yield pa.RecordBatch.from_arrays(own, names=[*names, "kind", "places", "xs"])
            kept.clear()

        for whole in batches:
            schema = whole.schema
            for at in range(0, whole.num_rows, kept.room):
                batch = whole.slice(at, kept.room)
                code = np.zeros(batch.num_rows, dtype=np.int64)
                for name in names:
                    coded = batch.column(name).dictionary_encode(null_encoding="encode")
                    code = np.unique(code * max(len(coded.dictionary), 1) + np.asarray(coded.indices), return_inverse=True)[1]
                first, code = np.unique(code, return_index=True, return_inverse=True)[1:]
                own = list(zip(*[batch.column(n).take(pa.array(first)).to_pylist() for n in names])) if names else [()] * len(first)
                if len(kept.groups.keys() | set(own)) > kept.room:
                    yield from given()
                code = np.array([kept.groups.setdefault(g, len(kept.groups)) for g in own], dtype=np.int64)[code]
                coded = batch.column("_text").dictionary_encode(null_encoding="encode")
                for rows, data, offsets in text_runs(lower_cased(coded.dictionary)):
                    n = len(offsets) - 1
                    text = np.asarray(coded.indices) - rows.start
                    here = (text >= 0) & (text < n)
                    row, place, weight, n_words = read(data, offsets)
                    pair, times = np.unique(code[here] * n + text[here], return_counts=True)
                    group, text = pair // n, pair % n
                    kept.add_lengths(group, n_words[text], times)
                    begin = np.searchsorted(row, np.arange(n + 1))
                    size = np.diff(begin)[text]
                    ends = np.cumsum(size)
                    done = 0
                    while done < len(pair):
                        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + RUN_VALUES, "right")))
                        each = size[done:stop]
                        cell = np.arange(each.sum()) + np.repeat(begin[text[done:stop]] - np.cumsum(each) + each, each)
                        to = np.repeat(group[done:stop] * kept.n_terms, each) + place[cell]
                        np.add.at(kept.sums, to, weight[cell] * np.repeat(times[done:stop], each))
                        done = stop
            pa.default_memory_pool().release_unused()  # a reused worker would keep what its largest batch took
        if kept.groups:
            yield from given()

    kinds = ", ".join(f"{n} {kind.simpleString()}" for n, kind in zip(names, types))
    made = narrow.mapInArrow(work, ", ".join(filter(None, [kinds, "kind string, places array<int>, xs array<double>"])))
    by_key = made.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "kind", "places", "xs")
    by_key = by_key.repartition(*[F.col(k) for k in keys]) if keys else by_key.repartition(1)
    cells = by_key.select(*keys, "kind", F.inline(F.arrays_zip("places", "xs")))
    return added_up(cells.select(*keys, "kind", F.col("places").cast("bigint").alias("place"), F.col("xs").alias("x")), keys)


def added_up(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Text sums of parts as those of the whole."""
    return sums.groupBy(*keys, "kind", "place").agg(F.sum("x").alias("x"))


def term_weights(weights: TermWeights, texts: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """Long form of the unit-length vectors: one row per text and known term, made in the task that reads the text.

    Texts that share an id are taken as texts of their own. Nothing is shuffled.
    """
    if not weights.terms:
        raise ValueError("the reference texts hold no terms")
    vocabulary, idf = list(weights.terms), np.array(weights.idf)
    narrow = weights.add_known(texts.select(F.col(id_column).alias("_id"), column), column).select("_id", "_terms")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in list_runs(batches, "_terms"):
            row, place, count = term_counts(batch.column("_terms"), known)
            weight = unit_length(row, count * idf[place], batch.num_rows)
            arrays = [batch.column("_id").take(pa.array(row)), known.take(pa.array(place)), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(arrays, names=["_id", "term", "weight"])

    kind = texts.schema[id_column].dataType.simpleString()
    return narrow.mapInArrow(work, f"_id {kind}, term string, weight double").withColumnRenamed("_id", id_column)


def centroid_table(weights: TermWeights, texts: DataFrame, column: str = "text") -> DataFrame:
    """Mean weight of every fitted term over the texts."""
    names = F.array(*[F.lit(t) for t in weights.terms])
    rows = F.arrays_zip(names.alias("term"), F.col("centroid").alias("mean_weight"))
    return weights.centroids(texts, column=column).select(F.inline(rows))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 when either has no length."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

    dot = total(F.zip_with(a, b, lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(a, lambda x: x * x))) * F.sqrt(total(F.transform(b, lambda x: x * x)))
    return F.coalesce(F.try_divide(dot, norm), F.lit(0.0))


def as_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def length_counts(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Texts per key and number of words, from text sums."""
    return sums.filter(F.col("kind") == "length").select(*keys, F.col("place").alias("value"), F.col("x").cast("bigint").alias("n"))


@dataclass(frozen=True)
class TextReference:
    """What is kept of the reference texts: fitted terms, their centroid, and the counts of text lengths.

    Terms and centroid have at most `max_features` numbers each and are fetched once; the length counts, one row per
    distinct length, are written to the scratch folder. Fitting reads the texts twice: for the terms, then for the rest.
    """

    weights: TermWeights
    centroid: tuple[float, ...]
    lengths: DataFrame

    @classmethod
    def fit(cls, texts: DataFrame, column: str = "text", max_features: int = MAX_FEATURES,
            stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> TextReference:
        weights = TermWeights.fit(texts, column, max_features, stop_words)
        sums = stored(text_sums(weights, texts, column=column), "reference-sums")
        lengths = length_counts(sums, [])
        total = lengths.agg(F.sum("n")).scalar()
        centroid = np.zeros(len(weights.terms))
        for r in sums.filter(F.col("kind") == "weight").select("place", (F.col("x") / total).alias("x")).collect():  # one per term
            centroid[r["place"]] = r["x"]
        return cls(weights, tuple(centroid.tolist()), lengths)

    def similarity(self, sums: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        """Cosine of each key's centroid with the reference's, and 1 minus it, from its text sums."""
        x = F.when(F.col("kind") == "weight", F.col("x"))
        place = F.when(F.col("kind") == "weight", F.col("place")).cast("int")
        found = sums.groupBy(*keys).agg(
            F.sum(x * F.get(as_array(self.centroid), place)).alias("_dot"), F.sum(x * x).alias("_norm")
        )
        norm = F.sqrt("_norm") * F.lit(float(np.sqrt(np.square(self.centroid).sum())))
        cosine_similarity = F.coalesce(F.try_divide("_dot", norm), F.lit(0.0)).alias("cosine_similarity")
        return found.select(*keys, cosine_similarity).withColumn("drift_score", 1.0 - F.col("cosine_similarity"))

    def centroid_drift(self, current: DataFrame, keys: Sequence[str] = (), column: str = "text") -> DataFrame:
        """Cosine similarity of each key's centroid with the reference's, and 1 minus it as the drift score."""
        return self.similarity(text_sums(self.weights, current, keys, column), keys)

    def data_drift(
        self, current: DataFrame, keys: Sequence[str] = ("deployment_id",), column: str = "input_text",
        threshold: float = 0.1, significance: float = 0.05, exact_cells: int = 0,
    ) -> DataFrame:
        """Text drift per key: centroid distance, and a two-sample test on word counts; the texts are read once.

        `exact_cells` is that of `ks_two_sample`.
        """
        keys = list(keys)
        return self.drift_of(stored(text_sums(self.weights, current, keys, column), "text-sums"), keys, threshold, significance, exact_cells)

    def drift_of(self, sums: DataFrame, keys: Sequence[str], threshold: float = 0.1, significance: float = 0.05,
                 exact_cells: int = 0) -> DataFrame:
        """Text drift per key from its text sums; they are read several times."""
        counts = length_counts(sums, keys)
        ks = ks_two_sample(self.lengths, counts, keys, exact_cells=exact_cells)
        ref_mean = self.lengths.select(F.sum(F.col("value") * F.col("n")) / F.sum("n")).scalar()
        averages = counts.groupBy(*keys).agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("new_avg_length"))
        centroid = self.similarity(sums, keys)
        if keys:
            joined = centroid.join(ks, keys).join(averages, keys)
        else:
            joined = centroid.withColumns(
                {c: ks.select(c).scalar() for c in ("ks_statistic", "p_value")}
                | {"new_avg_length": averages.select("new_avg_length").scalar()}
            )
        drift = (F.col("drift_score") > threshold) | (F.col("p_value") < significance)
        return joined.select(
            *keys,
            "cosine_similarity",
            "drift_score",
            F.col("ks_statistic").alias("length_ks_statistic"),
            F.col("p_value").alias("length_p_value"),
            ref_mean.alias("reference_avg_length"),
            "new_avg_length",
            F.lit(float(threshold)).alias("threshold"),
            drift.alias("is_drift_detected"),
            F.when(drift, F.greatest(F.col("drift_score"), 1.0 - F.col("p_value")))
            .otherwise(1.0 - F.col("drift_score"))
            .alias("confidence"),
        )
