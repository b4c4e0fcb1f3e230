"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is summed over all its
segmentations by a forward algorithm, a text's is the product over its words (A-Z lower-cased, each led by the word mark;
no piece crosses a word mark), and the languages' posterior with equal priors is the score.

The piece probabilities are fitted by expectation maximisation on a bounded sample of labelled rows: at most about
`texts_per_language` texts of each language, chosen by a hash, with all their words. Words of scripts without spaces are cut
where no piece spans before they are summed, which changes no sum and keeps their cost that of short words.
Scoring reads whole texts and is a narrow pass; a word's scores are kept between batches of a task up to `kept_words`.

Defined cases: NULL texts and texts without a letter are `und` with score 0; ties go to the language that sorts first; when
nothing could be learned every text is `und` with score 0; repeated rows are judged alike; an empty table gives an empty
result. Columns other than text (and, to learn, lang and doc_id) are not read; those named by `keep` are carried along.
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
from tallywatch.llm.lattice import SPACE, Lattice, cut_units, distinct_words, in_batches, vocabulary

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    vocabulary: str = "/opt/tokenizers/piece_bpe_32k.model"
    texts_per_language: int = 600
    rounds: int = 3
    smoothing: float = 0.02
    kept_words: int = 1_000_000
    run_bytes: int = 16 << 20


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    logs: np.ndarray  # piece (unknown last) x language
    params: Params


def _word_counts(docs: DataFrame, params: Params) -> DataFrame:
    """(lang, word, n) of the sampled texts; a text's words are counted before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for run in W.runs(batch.column("text")):
                data, start, end, _, (word, row) = distinct_words(run)
                raw = data.tobytes()
                names = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start, end)]
                own = np.array(lang[run.rows], dtype=object)
                for name in sorted(set(own)):
                    of, n = np.unique(word[np.isin(row, np.flatnonzero(own == name))], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(of), pa.string()), pa.array([names[i] for i in of], pa.string()), pa.array(n)],
                        names=["lang", "word", "n"],
                    )

    return docs.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, params: Params = Params()) -> Model:
    """Piece probabilities per language from the rows of `labelled` (doc_id, text, lang) with text and lang."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("texts"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30))
    share = F.col("texts").cast("double") / params.texts_per_language
    # one row per language; the model itself holds far more for each of them
    sample = rows.join(F.broadcast(sizes), "lang").filter(place * share < (1 << 30)).select("lang", "text")
    table = _word_counts(sample, params).toPandas()  # the words of a bounded number of texts
    vocab = vocabulary(params.vocabulary)
    languages = tuple(sorted(table["lang"].unique()))
    logs = np.empty((vocab.size + 1, len(languages)))
    logs[:] = np.append(vocab.scores, vocab.unknown_score)[:, None] / 1e6
    if not languages:
        return Model(languages, logs, params)
    words = sorted(table["word"].unique())
    number = {w: i for i, w in enumerate(words)}
    counts = np.zeros((len(words), len(languages)))
    counts[table["word"].map(number), table["lang"].map(languages.index)] = table["n"]
    units, owner = cut_units(vocab, [SPACE + w for w in words])
    for _ in range(params.rounds):
        uses = np.full_like(logs, params.smoothing)
        for batch in in_batches(units):
            uses += Lattice(vocab, [units[i] for i in batch]).expected(logs, counts[owner[batch]])
        logs = np.log(uses / uses.sum(axis=0))
    return Model(languages, logs, params)


class _Scorer:
    """Scores of words, kept between calls up to a number of words."""

    def __init__(self, model: Model):
        self.model, self.vocab = model, vocabulary(model.params.vocabulary)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.values = np.zeros((0, len(self.model.languages)))

    def texts(self, run: W.Run) -> np.ndarray:
        """Log probability of every row in every language."""
        data, start, end, keys, (word, row) = distinct_words(run)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            place = np.minimum(place, len(self.keys) - 1)
            known = self.keys[place] == keys
        values = np.empty((len(keys), len(self.model.languages)))
        values[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        raw = data.tobytes()
        units, owner = cut_units(self.vocab, [SPACE + raw[a:b].decode("utf-8", "replace") for a, b in zip(start[new], end[new])])
        distinct = list(dict.fromkeys(units))  # parts of long words repeat
        number = {u: i for i, u in enumerate(distinct)}
        sums = np.empty((len(distinct), values.shape[1]))
        for batch in in_batches(distinct):
            sums[batch] = Lattice(self.vocab, [distinct[i] for i in batch]).scores(self.model.logs)
        part = np.fromiter((number[u] for u in units), dtype=np.int64, count=len(units))
        for k in range(values.shape[1]):
            values[new, k] = np.bincount(owner, sums[part, k], minlength=len(new))
        if len(self.keys) + len(new) > self.model.params.kept_words:
            self.clear()
            new = new[: self.model.params.kept_words]
        order = np.argsort(every := np.concatenate([self.keys, keys[new]]), kind="stable")
        self.keys, self.values = every[order], np.concatenate([self.values, values[new]])[order]
        return np.stack([np.bincount(row, values[word, k], minlength=run.n) for k in range(values.shape[1])], axis=1)


def _lettered(run: W.Run) -> np.ndarray:
    """Whether each row holds a letter."""
    ascii_letters = run.per_row((W.LOWER[run.data] >= 97) & (W.LOWER[run.data] <= 122)) > 0
    for i in np.flatnonzero(~ascii_letters):
        text = run.data[run.offsets[i] : run.offsets[i + 1]].tobytes().decode("utf-8", "replace")
        ascii_letters[i] = any(map(str.isalpha, text))
    return ascii_letters


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The `keep` columns of every row with lang_pred and score."""
    carried = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)]
    fields = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    languages = np.array([*model.languages, UNKNOWN], dtype=object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for run in W.runs(batch.column("_text"), model.params.run_bytes):
                pick, score = np.full(run.n, len(languages) - 1), np.zeros(run.n)
                if model.languages:
                    sums = scorer.texts(run)
                    told = _lettered(run)
                    best = sums.argmax(axis=1)
                    pick[told] = best[told]
                    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    score[told] = share[told]
                part = batch.slice(run.rows.start, run.n)
                arrays = [part.column(f"_{i}") for i in range(len(keep))]
                arrays += [pa.array(languages[pick].tolist(), pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    made = docs.select(*carried, F.col("text").cast("string").alias("_text")).mapInArrow(work, schema)
    return made.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def held_out(remainder: int, of: int):
    """Whether a row's checksum puts it into the held-out fold; rows without a doc_id are in none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == remainder, F.lit(False))
