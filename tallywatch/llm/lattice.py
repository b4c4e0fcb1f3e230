"""Segmentations of short texts into the pieces of a fixed public vocabulary, many texts at a time.

A text is a path through its lattice: an edge per vocabulary piece found in it, and an edge of one character where no piece
of one character is. `Lattice` finds all edges of a batch of units with numpy; on it run the best path (max-plus), the sum
over all paths (log-sum-exp), and expected piece counts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import sentencepiece

from tallywatch.llm import words as W

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
LOWEST = np.int64(-(1 << 60))
LONG = 32  # characters above which a unit is cut


class Vocabulary:
    """Pieces of a SentencePiece model with integer scores.

    A unigram model's own scores are taken. A merge model has merge ranks instead, which Zipf's law turns into log
    probabilities: a piece of rank r scores -log(r + 2.7). Scores are rounded to millionths, as integers, so sums are exact
    and do not depend on how a text is cut.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.surfaces: list[bytes] = [b""] * self.size
        texts: dict[int, str] = {}
        raw = np.zeros(self.size)
        for i in range(self.size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(text[3:5], 16)
                self.byte_ids[value] = i
                self.surfaces[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                texts[i] = text
                raw[i] = model.get_score(i)
                self.surfaces[i] = text.replace(SPACE, " ").encode()
        ids = np.array(sorted(texts), dtype=np.int64)
        merges = len(ids) > 0 and bool((raw[ids] == np.round(raw[ids])).all())
        if merges:
            rank = np.argsort(np.argsort(-raw[ids], kind="stable"), kind="stable")
            raw[ids] = -np.log(rank + 2.7)
        self.scores = np.rint(raw * 1e6).astype(np.int64)
        self.unknown_score = np.int64(self.scores[ids].min() - 10_000_000)
        self.longest = max(map(len, texts.values()))
        self._prefixes = self._levels(texts)

    def _levels(self, texts: dict[int, str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every length: sorted hashes of the piece prefixes of that length, and the piece each is (-1: none)."""
        levels: list[dict[int, int]] = [{} for _ in range(self.longest)]
        base, wrap = int(_BASE), (1 << 64) - 1
        for i, text in texts.items():
            value = 0
            for k, char in enumerate(text):
                value = (value * base + ord(char) + 1) & wrap
                levels[k].setdefault(value, -1)
            levels[len(text) - 1][value] = i
        out = []
        for level in levels:
            keys = np.array(sorted(level), dtype=np.uint64)
            out.append((keys, np.array([level[int(k)] for k in keys], dtype=np.int64)))
        return out

    def edges(self, chars: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(length, position) -> piece beginning there with that length, -1 for none; `end` is where each char's unit ends.

        A one-character edge without a piece is `size`: an unknown character.
        """
        out = np.full((self.longest, len(chars)), -1, dtype=np.int32)
        at = np.arange(len(chars))
        value = np.zeros(len(chars), dtype=np.uint64)
        for k, (keys, piece) in enumerate(self._prefixes):
            fits = at + k < end[at]
            at, value = at[fits], value[fits]
            value = value * _BASE + chars[at + k].astype(np.uint64) + np.uint64(1)
            place = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
            alive = keys[place] == value
            out[k, at[alive]] = piece[place[alive]]
            if k == 0:
                out[0][out[0] < 0] = self.size
            at, value = at[alive], value[alive]
            if not len(at):
                break
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once per process."""
    return Vocabulary(path)


class Lattice:
    """Edges of a batch of units, longest unit first."""

    def __init__(self, vocab: Vocabulary, units: list[str]):
        self.vocab = vocab
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        text = "".join([units[i] for i in self.order])
        self.chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.edge = vocab.edges(self.chars, np.repeat(self.begin + self.lengths, self.lengths))
        self.width = int(self.lengths[0]) if len(units) else 0

    def _steps(self):
        """(position k, length m, units with an edge that ends at k and has length m, their pieces), k in order."""
        at_least = np.searchsorted(-self.lengths, -np.arange(self.width + 1), "right")
        for k in range(1, self.width + 1):
            begin = self.begin[: at_least[k]]
            for m in range(1, min(self.vocab.longest, k) + 1):
                piece = self.edge[m - 1, begin + (k - m)]
                unit = np.flatnonzero(piece >= 0)
                if len(unit):
                    yield k, m, unit, piece[unit]

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the best paths one after the other, units in the lattice's own order, and where each unit's pieces end.

        `size` stands for an unknown char. Of equally good last pieces the shortest is taken.
        """
        vocab, n = self.vocab, len(self.lengths)
        score = np.append(vocab.scores, vocab.unknown_score)
        value = np.full((self.width + 1, n), LOWEST, dtype=np.int64)
        value[0] = 0
        back = np.zeros((self.width + 1, n), dtype=np.int16)
        for k, m, unit, piece in self._steps():
            new = value[k - m, unit] + score[piece]
            better = new > value[k, unit]
            unit = unit[better]
            value[k, unit], back[k, unit] = new[better], m
        at, unit = self.lengths.copy(), np.arange(n)
        steps, owners = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        unit = unit[at > 0]
        while len(unit):
            m = back[at[unit], unit].astype(np.int64)
            at[unit] -= m
            steps.append(self.edge[m - 1, self.begin[unit] + at[unit]])
            owners.append(unit)
            unit = unit[at[unit] > 0]
        owner, piece = np.concatenate(owners)[::-1], np.concatenate(steps)[::-1]
        return piece[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner, minlength=n))

    def best(self) -> list[np.ndarray]:
        """Pieces of the best path of every unit, in the order of the units given."""
        piece, ends = self.paths()
        out: list = [None] * len(ends)
        for i, place in enumerate(self.order):
            out[place] = piece[ends[i - 1] if i else 0 : ends[i]]
        return out

    def forward(self, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of the summed probability of all paths to each position; `logs` is piece (unknown last) x language.

        Returns (position, unit, language), and the whole units' (unit, language) in the lattice's own order.
        """
        alpha = np.full((self.width + 1, len(self.lengths), logs.shape[1]), -np.inf)
        alpha[0] = 0
        for k, m, unit, piece in self._steps():
            alpha[k, unit] = np.logaddexp(alpha[k, unit], alpha[k - m, unit] + logs[piece])
        return alpha, alpha[self.lengths, np.arange(len(self.lengths))]

    def scores(self, logs: np.ndarray) -> np.ndarray:
        """Log probability of every unit in every language, in the order of the units given."""
        out = np.empty((len(self.lengths), logs.shape[1]))
        out[self.order] = self.forward(logs)[1]
        return out

    def expected(self, logs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece (unknown last) per language; `counts` is unit x language."""
        alpha, whole = self.forward(logs)
        weight = counts[self.order]
        beta = np.full_like(alpha, -np.inf)
        beta[self.lengths, np.arange(len(self.lengths))] = 0
        out = np.zeros_like(logs)
        for k, m, unit, piece in reversed(list(self._steps())):
            along = logs[piece] + beta[k, unit]
            beta[k - m, unit] = np.logaddexp(beta[k - m, unit], along)
            np.add.at(out, piece, weight[unit] * np.exp(alpha[k - m, unit] + along - whole[unit]))
        return out


def cut_units(vocab: Vocabulary, units: list[str], longer: int = LONG, block: int = 1 << 16) -> tuple[list[str], np.ndarray]:
    """The units with long ones cut wherever no piece spans, and the unit that each part belongs to.

    Every path goes through such a place, so sums over paths, best paths and their ties are those of the whole unit. Scripts
    written without spaces fall into parts of few characters.
    """
    parts, owner = [], []
    for i, unit in enumerate(units):
        if len(unit) <= longer:
            parts.append(unit)
            owner.append(i)
            continue
        chars = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        inside = np.zeros(len(chars) + 1, dtype=bool)  # whether an edge reaches over the place before a character
        for low in range(0, len(chars), block):
            part = chars[low : low + block + vocab.longest]
            edge = vocab.edges(part, np.full(len(part), len(part)))[:, :block]
            change = np.zeros(len(part) + 2, dtype=np.int64)
            for m in range(2, vocab.longest + 1):
                begin = np.flatnonzero(edge[m - 1] >= 0)
                np.add.at(change, begin + 1, 1)
                np.add.at(change, begin + m, -1)
            inside[low : low + len(part) + 1] |= np.cumsum(change)[: len(part) + 1] > 0
        cuts = np.flatnonzero(~inside).tolist()
        parts += [unit[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        owner += [i] * (len(cuts) - 1)
    return parts, np.array(owner, dtype=np.int64)


def in_batches(units: list[str], chars: int = 1 << 16):
    """Index ranges of the units with about so many characters each, units of similar length together."""
    lengths = np.array([len(u) for u in units], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    lengths = lengths[order]
    sums = np.cumsum(lengths)
    low = 0
    while low < len(order):
        full = np.searchsorted(sums, sums[low] - lengths[low] + chars, "right")
        longer = np.searchsorted(lengths, 4 * lengths[low] + 8, "right")
        high = max(low + 1, int(min(full, longer)))
        yield order[low:high].tolist()
        low = high


def distinct_words(run: W.Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct lower-cased (A-Z) words of a run: bytes, first begin, first end and hash of each; hash of every word; rows."""
    lowered = W.LOWER[run.data]
    start, end, row = run.words(lowered)
    hashes = W.span_hashes(lowered, start, end)
    keys, first = np.unique(hashes, return_index=True)
    return lowered, start[first], end[first], keys, np.stack([np.searchsorted(keys, hashes), row])
