"""Quality rules by distribution divergence.

Every text is compared with references of the languages in the corpus: the Jensen-Shannon distance of its
character-class histogram and of its common-word histogram to one and the same reference: its own language's when the text
is within the limits there, else that of the smallest sum. The word limit stays below the distance that a text without any
common word has (`word_limits`); references with less than `common_mass` of common words have no word rule. Short texts are not judged by a
distance (`min_words`). The references come from all texts: a language's common words are the words that make up at least
`common_share` of its words, so there are at most 1 / common_share of them.

Counting is exact and its tables are bounded. A task first reports only words above an eighth of that share in what it has
read; a word at the full share keeps at least 7/8 of its count this way, so at most 8 / (7 * common_share) candidates per
language remain, and those are then counted in full. Languages (NULL is one of its own) below `language_words` words get no
reference: nothing can be said about their texts, which pass the distances and say so in `reason`.

Defined cases: a NULL or empty text has no words and fails the base rules; texts below `min_words` words pass the
distances (`reason` tells: base, distance, too short, no reference, or NULL for a text that was judged and kept); without references (empty table) nothing fails by distance; repeated rows are judged alike; other columns of the
input are kept by `judge` and ignored by `references`.
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
from tallywatch.llm.scratch import cut

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "accented", "wide", "control")


def _class_table() -> np.ndarray:
    """Class of every byte; bytes that continue a character have none (9)."""
    kind = np.full(256, 8, dtype=np.int64)
    for low, high, value in ((33, 127, 5), (65, 91, 1), (97, 123, 0), (48, 58, 2), (128, 192, 9), (192, 224, 6), (224, 256, 7)):
        kind[low:high] = value
    kind[[ord(c) for c in ".,;:!?'\"()-"]] = 4
    kind[W.SPACE] = 3
    return kind


_KIND = _class_table()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_COUNTED = (np.arange(256) & 0xC0 != 0x80) & ~W.SPACE


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_class_distance: float = 0.30
    max_word_distance: float = 0.45
    common_share: float = 0.004
    language_words: int = 1000
    common_mass: float = 0.05
    word_margin: float = 0.95
    base_min_words: int = 10
    base_repeat_percent: int = 20


@dataclass(frozen=True)
class References:
    """Per language: class shares, and common-word shares with the rest of the words last."""

    languages: tuple
    hashes: np.ndarray  # sorted word hashes of all languages
    classes: np.ndarray  # language x class
    words: np.ndarray  # language x (hash, other)


def _classes(run: W.Run) -> np.ndarray:
    """Row x class counts of characters."""
    out = np.zeros((run.n, 10), dtype=np.int64)
    for at in range(0, len(run.data), W.BLOCK_BYTES):
        part = run.data[at : at + W.BLOCK_BYTES]
        row = np.searchsorted(run.offsets, np.arange(at, at + len(part)), "right") - 1 if run.n > 1 else 0
        out += np.bincount(_KIND[part] + 10 * row, minlength=10 * run.n).reshape(run.n, 10)
    return out[:, :9]


def _word_hashes(run: W.Run) -> tuple[np.ndarray, np.ndarray]:
    lowered = W.LOWER[run.data]
    start, end, row = run.words(lowered)
    return W.span_hashes(lowered, start, end), row


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    out = np.empty(len(keys), dtype=bool)
    out[order] = same[1:] | same[:-1]
    return out


def _base(run: W.Run) -> dict[str, np.ndarray]:
    start, end, row = run.words()
    hashes = W.span_hashes(run.data, start, end)
    salt = W.mix(np.arange(1, run.n + 1, dtype=np.uint64))
    keys, at = W.windows(hashes, row, 5)
    found = at[_repeated(keys ^ salt[row[at]])]
    covered = np.zeros(len(row) + 1, dtype=np.int64)
    np.add.at(covered, found, 1)
    np.add.at(covered, found + 5, -1)
    repeat = row[np.cumsum(covered[:-1]) > 0]

    newline = np.flatnonzero(run.data == 10)
    begins = np.unique(np.concatenate([run.offsets[:-1], newline + 1]))
    begins = begins[begins < len(run.data)]
    owner = np.searchsorted(run.offsets, begins, "right") - 1
    ends = np.append(begins[1:], len(run.data)) if len(begins) else begins
    ends = ends - (run.data[ends - 1] == 10) if len(begins) else ends
    first_word = np.searchsorted(start, begins)
    holds = (first_word < len(start)) & (np.append(start, np.iinfo(np.int64).max)[first_word] < ends)
    begins, ends, owner = begins[holds], ends[holds], owner[holds]
    lines = W.span_hashes(run.data, begins, ends) ^ salt[owner]
    order = np.argsort(lines, kind="stable")
    again = np.zeros(len(lines), dtype=bool)
    again[order[1:]] = lines[order][1:] == lines[order][:-1]
    count = lambda rows: np.bincount(rows, minlength=run.n).astype(np.int64)
    return {
        "n_words": count(row),
        "word_chars": run.per_row(_COUNTED[run.data]),
        "n_symbols": run.per_row(_SYMBOL[run.data]),
        "n_dup_lines": count(owner[again]),
        "n_repeat_words": count(repeat),
    }


def _js(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of every row of `p` to `q`."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)


_TALLY = "lang string, kind string, key long, n long"


def _tally(df: DataFrame, known: np.ndarray | None, share: float) -> DataFrame:
    """Class and word counts per language: of the known words, or of those above `share` of what a task has read."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages: list = []
        classes: list[np.ndarray] = []
        words: list[tuple[np.ndarray, np.ndarray]] = []

        def merged(i: int) -> tuple[np.ndarray, np.ndarray]:
            return words[i]

        for batch in batches:
            codes = batch.column("lang").dictionary_encode()
            names = codes.dictionary.to_pylist() + [None]
            code = codes.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
            for run in W.runs(batch.column("text")):
                by_row = _classes(run)
                hashes, row = _word_hashes(run)
                if known is not None:
                    hit = np.isin(hashes, known)
                    hashes, row = hashes[hit], row[hit]
                for c in np.unique(code[run.rows]):
                    own = code[run.rows] == c
                    if names[c] not in languages:
                        languages.append(names[c])
                        classes.append(np.zeros(9, dtype=np.int64))
                        words.append((np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)))
                    i = languages.index(names[c])
                    classes[i] += by_row[own].sum(axis=0)
                    keys, n = np.unique(hashes[own[row]], return_counts=True)
                    old_keys, old_n = merged(i)
                    keys, place = np.unique(np.concatenate([old_keys, keys]), return_inverse=True)
                    words[i] = keys, np.bincount(place, np.concatenate([old_n, n])).astype(np.int64)
                    if len(keys) > 1_000_000:
                        yield from report(languages[i], classes[i], *words[i])
                        classes[i] = np.zeros(9, dtype=np.int64)
                        words[i] = keys[:0], n[:0].astype(np.int64)
        for i, name in enumerate(languages):
            yield from report(name, classes[i], *words[i])

    def report(name, classes: np.ndarray, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = int(n.sum())
        often = n >= share * total
        kinds = ["class"] * 9 + ["total"] + ["word"] * int(often.sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * len(kinds), pa.string()),
                pa.array(kinds),
                pa.array(np.concatenate([np.arange(9), [0], keys[often].view(np.int64)])),
                pa.array(np.concatenate([classes, [total], n[often]])),
            ],
            names=["lang", "kind", "key", "n"],
        )

    counted = df.select(F.col("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(count, _TALLY)
    return counted.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, limits: Limits = Limits()) -> References:
    """Class and common-word shares of every language, from all texts of `docs` (columns text, lang)."""
    share = limits.common_share
    first = cut(_tally(docs, None, share / 8))
    totals = first.filter("kind = 'total' AND n > 0").select("lang", F.col("n").alias("total"))
    large = totals.filter(F.col("total") >= limits.language_words)
    kept = first.join(large, first["lang"].eqNullSafe(large["lang"])).drop(large["lang"])
    found = kept.filter((F.col("kind") != "word") | (F.col("n") >= 0.875 * share * F.col("total"))).collect()
    languages = sorted({r["lang"] for r in found}, key=lambda x: (x is None, x))
    place = {name: i for i, name in enumerate(languages)}
    classes, total = np.zeros((len(languages), 9)), np.zeros(len(languages))
    for r in found:
        if r["kind"] == "class":
            classes[place[r["lang"]], r["key"]] = r["n"]
        elif r["kind"] == "total":
            total[place[r["lang"]]] = r["n"]
    candidates = np.unique(np.array([r["key"] for r in found if r["kind"] == "word"], dtype=np.int64).view(np.uint64))
    counts = np.zeros((len(languages), len(candidates)))
    if len(candidates):
        second = _tally(docs, candidates, 0.0).filter("kind = 'word'")
        for r in second.join(large, second["lang"].eqNullSafe(large["lang"])).drop(large["lang"]).collect():
            counts[place[r["lang"]], np.searchsorted(candidates, np.int64(r["key"]).view(np.uint64))] = r["n"]
    common = counts / np.maximum(total, 1)[:, None]
    common[common < share] = 0
    used = common.any(axis=0)
    common = common[:, used]
    rest = np.maximum(1 - common.sum(axis=1, keepdims=True), 0)
    return References(tuple(languages), candidates[used], _shares(classes), np.hstack([common, rest]))


def word_limits(refs: References, limits: Limits = Limits()) -> np.ndarray:
    """Largest word distance to each reference; infinite where too few words are common for a rule."""
    none = np.zeros(refs.words.shape)
    none[:, -1] = 1
    bare = np.array([_js(p[None, :], q)[0] for p, q in zip(none, refs.words)])
    return np.where(1 - refs.words[:, -1] < limits.common_mass, np.inf, np.minimum(limits.max_word_distance, limits.word_margin * bare))


def distances(run: W.Run, refs: References, own: np.ndarray, limits: Limits = Limits()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and common-word distance of each row to one reference, and whether they are over the limits.

    `own` is the place of each row's language among the references, -1 without one: such rows are never over the limits.
    """
    by_class, by_word, far = np.zeros(run.n), np.zeros(run.n), np.zeros(run.n, dtype=bool)
    if not refs.languages:
        return by_class, by_word, far
    hashes, row = _word_hashes(run)
    place = np.searchsorted(refs.hashes, hashes)
    place[place == len(refs.hashes)] = 0
    width = len(refs.hashes)
    if width:
        place = np.where(refs.hashes[place] == hashes, place, width)
    seen = np.bincount(row * (width + 1) + place, minlength=run.n * (width + 1)).reshape(run.n, width + 1)
    classes, seen = _shares(_classes(run)), _shares(seen)
    most = word_limits(refs, limits)

    def to(k: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        common = np.append(refs.words[k, :-1] > 0, True)  # words common in other languages only are "other" here
        folded = seen[np.ix_(rows, common)]
        folded[:, -1] += seen[np.ix_(rows, ~common)].sum(axis=1)
        one = _js(classes[rows], refs.classes[k])
        two = _js(folded, refs.words[k, common]) if np.isfinite(most[k]) else np.zeros(len(rows))
        return one, two, (one > limits.max_class_distance) | (two > most[k])

    for k in np.unique(own[own >= 0]):
        rows = np.flatnonzero(own == k)
        by_class[rows], by_word[rows], far[rows] = to(int(k), rows)
    rows = np.flatnonzero(far | (own < 0))
    if len(rows):
        every = [to(k, rows) for k in range(len(refs.languages))]
        near = np.argmin([one + two for one, two, _ in every], axis=0)
        at = np.arange(len(rows))
        by_class[rows], by_word[rows], over = (np.stack([e[i] for e in every])[near, at] for i in range(3))
        far[rows] = over & (own[rows] >= 0)
    return by_class, by_word, far


JUDGED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean, reason string"


_REASONS = np.array(["base", "too short", "no reference", "distance", None], dtype=object)


def judge(docs: DataFrame, refs: References, limits: Limits = Limits(), keep: list[str] | None = None, only_kept: bool = False) -> DataFrame:
    """Add features, distances and the verdict to every row (columns text, lang); `keep` names the columns to carry along (default all).

    `only_kept` returns the kept rows with the carried columns alone.
    """
    columns = [c for c in (docs.columns if keep is None else keep)]
    carried = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)]
    added = T._parse_datatype_string(JUDGED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {name: i for i, name in enumerate(refs.languages)}
        for batch in batches:
            langs = batch.column("_lang").to_pylist()
            for run in W.runs(batch.column("_text")):
                out = _base(run)
                out["base_failed"] = (out["n_words"] < limits.base_min_words) | (
                    100 * out["n_repeat_words"] > limits.base_repeat_percent * out["n_words"]
                )
                own = np.array([places.get(x, -1) for x in langs[run.rows]], dtype=np.int64)
                out["class_distance"], out["word_distance"], far = distances(run, refs, own, limits)
                long = out["n_words"] >= limits.min_words
                out["kept"] = ~out["base_failed"] & ~(far & long)
                cases = [out["base_failed"], ~long, own < 0, far]
                out["reason"] = np.select(cases, _REASONS[:4], _REASONS[4])
                part = batch.slice(run.rows.start, run.n)
                arrays = [part.column(f"_{i}") for i in range(len(columns))]
                if only_kept:
                    yield pa.RecordBatch.from_arrays(arrays, names=[f"_{i}" for i in range(len(columns))]).filter(pa.array(out["kept"]))
                else:
                    arrays += [pa.array(out[f.name].tolist() if f.name == "reason" else out[f.name], pa.string() if f.name == "reason" else None) for f in added]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*[f"_{i}" for i in range(len(columns))], *added.names])

    fields = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(columns)]
    schema = T.StructType(fields + ([] if only_kept else list(added)))
    made = docs.select(*carried, F.col("text").cast("string").alias("_text"), F.col("lang").cast("string").alias("_lang")).mapInArrow(work, schema)
    back = [F.col(f"_{i}").alias(c) for i, c in enumerate(columns)]
    return made.select(*back) if only_kept else made.select(*back, *added.names)
