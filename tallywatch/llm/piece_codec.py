"""SentencePiece encoding and decoding with a max-plus parallel scan over giant texts.

A text is led by a space, spaces become word marks, and the best path through the lattice of vocabulary pieces gives its ids;
characters outside the vocabulary become byte pieces. As no piece goes from a character to a word mark or holds a line
feed, texts fall into units that are solved by themselves; a task keeps the ids of units it has seen (`kept_units`).

A text longer than `chunk_chars` is cut into chunks, rows of their own. A piece may reach over a cut by fewer characters
than the longest piece, so a chunk is a transfer matrix: entry (i, j) is the best score from i characters after its
beginning to j characters after its end. The matrices combine associatively (max-plus), by a doubling scan per text; the
boundary states of the best path follow from the prefixes, and every chunk is then backtraced by itself. Scores are
integers, so the result has the same total score as without cuts.

Defined cases: a NULL text has no ids, an empty text too; repeated rows are encoded alike; an empty table gives an empty
result; other columns are carried along when named in `keep`. Decoding gives the text back but for word marks that stood in
the text itself, which become spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.lattice import LONG, LOWEST, SPACE, Lattice, Vocabulary, cut_units, in_batches, vocabulary
from tallywatch.llm.scratch import cut

_UNITS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


@dataclass(frozen=True)
class Params:
    vocabulary: str = "/opt/tokenizers/piece_bpe_32k.model"
    chunk_chars: int = 1 << 16
    kept_units: int = 100_000


def marked(text: str) -> str:
    """The text as pieces see it."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Encoder:
    """Ids of texts and of parts of texts."""

    def __init__(self, params: Params):
        self.params, self.vocab = params, vocabulary(params.vocabulary)
        self.known: dict[str, bytes] = {}

    def _learn(self, units: set[str]) -> None:
        new = list(units.difference(self.known))
        if len(self.known) + len(new) > self.params.kept_units:
            self.known = {u: self.known[u] for u in units if u in self.known}
        self.known |= self._solved([u for u in new if len(u) <= LONG])
        long = [u for u in new if len(u) > LONG]
        if long:
            parts, owner = cut_units(self.vocab, long)
            solved = self._solved(list(dict.fromkeys(parts)))
            first = np.searchsorted(owner, np.arange(len(long) + 1)).tolist()
            for unit, low, high in zip(long, first[:-1], first[1:]):
                self.known[unit] = b"".join(map(solved.__getitem__, parts[low:high]))

    def _solved(self, units: list[str]) -> dict[str, bytes]:
        out = {}
        for batch in in_batches(units):
            lattice = Lattice(self.vocab, [units[i] for i in batch])
            own = [units[batch[k]] for k in lattice.order.tolist()]
            pieces, ends = lattice.paths()
            begins = np.append(0, ends[:-1])
            raw = pieces.astype("<u4").tobytes()
            out.update(zip(own, map(raw.__getitem__, map(slice, (4 * begins).tolist(), (4 * ends).tolist()))))
            for k in np.unique(np.searchsorted(ends, np.flatnonzero(pieces == self.vocab.size), "right")).tolist():
                out[own[k]] = self._ids(own[k], pieces[begins[k] : ends[k]])
        return out

    def _ids(self, unit: str, pieces: np.ndarray) -> bytes:
        """Ids of a unit with unknown characters."""
        out, at = [], 0
        for piece in pieces:
            if piece == self.vocab.size:
                out += [self.vocab.byte_ids[b] for b in unit[at].encode("utf-8", "surrogatepass")]
                at += 1
            else:
                out.append(piece)
                at += len(self._text(piece))
        return np.array(out, dtype="<u4").tobytes()

    def _text(self, piece: int) -> str:
        return self.vocab.surfaces[piece].decode()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each marked text."""
        units = [_UNITS.findall(t) for t in texts]
        self._learn(set().union(*units))
        return [b"".join(map(self.known.__getitem__, u)) for u in units]

    def decode(self, ids: bytes) -> str:
        surfaces = self.vocab.surfaces
        text = b"".join([surfaces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _spread(vocab: Vocabulary, text: str, value: np.ndarray, first: int, last: int) -> np.ndarray:
    """Best scores at each position of `text`, row per position, column per start state.

    `value` has the scores at the positions up to `first` + its length; edges begin from position `first` and before `last`.
    """
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    edge = vocab.edges(chars, np.full(len(chars), len(chars)))
    score = np.append(vocab.scores, vocab.unknown_score)
    out = np.full((len(chars) + 1, value.shape[1]), LOWEST, dtype=np.int64)
    out[first : first + len(value)] = value
    for at in range(first, last):
        if (out[at] <= LOWEST).all():
            continue
        for m in np.flatnonzero(edge[:, at] >= 0) + 1:
            new = np.where(out[at] > LOWEST, out[at] + score[edge[m - 1, at]], LOWEST)
            np.maximum(out[at + m], new, out=out[at + m])
    return out


def transfer(encoder: Encoder, text: str, size: int) -> np.ndarray:
    """Transfer matrix of a chunk of `size` characters whose `text` also has the characters that a piece may reach into.

    Between the first and the last place where units part, the chunk's units are solved at once; only its ends are walked.
    """
    vocab = encoder.vocab
    width = vocab.longest
    identity = np.full((width, width), LOWEST, dtype=np.int64)
    np.fill_diagonal(identity, 0)
    parts = [m.start() for m in _UNITS.finditer(text)]
    inner = [p for p in parts if width <= p <= size]
    if not inner:
        walked = _spread(vocab, text, identity, 0, size)
        return _ends(walked, size, width)
    low, high = inner[0], inner[-1]
    head = _spread(vocab, text[:low], identity[: min(width, low + 1)], 0, low)[low]
    score = np.append(vocab.scores, 0)
    middle = 0
    if high > low:
        units = _UNITS.findall(text[low:high])
        for batch in in_batches(units):
            own = [units[i] for i in batch]
            for pieces in Lattice(vocab, own).best():
                middle += int(score[pieces].sum()) + int(vocab.unknown_score) * int((pieces == vocab.size).sum())
    walked = _spread(vocab, text[high:], np.zeros((1, 1), dtype=np.int64), 0, size - high)
    tail = _ends(walked, size - high, width)[0]
    both = head[:, None] + middle + tail[None, :]
    return np.where((head[:, None] > LOWEST) & (tail[None, :] > LOWEST), both, LOWEST)


def _ends(walked: np.ndarray, size: int, width: int) -> np.ndarray:
    out = np.full((walked.shape[1], width), LOWEST, dtype=np.int64)
    reach = walked[size : size + width]
    out[:, : len(reach)] = reach.T
    return out


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product of stacks of transfer matrices."""
    out = np.full_like(left, LOWEST)
    for k in range(left.shape[-1]):
        a, b = left[..., :, k, None], right[..., None, k, :]
        np.maximum(out, np.where((a > LOWEST) & (b > LOWEST), a + b, LOWEST), out=out)
    return out


def boundary_states(matrices: np.ndarray) -> np.ndarray:
    """States of the best path at the chunk beginnings and the last end, from the chunks' transfer matrices in order."""
    prefix, step = matrices.copy(), 1
    while step < len(prefix):  # doubling: afterwards prefix[t] is the product of the matrices up to t
        prefix[step:] = combine(prefix[:-step].copy(), prefix[step:])
        step *= 2
    states = np.zeros(len(matrices) + 1, dtype=np.int64)
    for t in range(len(matrices) - 1, 0, -1):
        before, along = prefix[t - 1][0], matrices[t][:, states[t + 1]]
        states[t] = int(np.where((before > LOWEST) & (along > LOWEST), before + along, LOWEST).argmax())
    return states


_CHUNK = "row long, chunk long, chunks long, size long, text string"


def _chunks(long_texts: DataFrame, params: Params) -> DataFrame:
    """Chunks of marked texts, each with the characters after it that a piece may reach into."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = vocabulary(params.vocabulary).longest
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                text = marked(text)
                cuts = list(range(0, max(len(text) - reach, 1), params.chunk_chars)) + [len(text)]
                for k in range(len(cuts) - 1):
                    part = text[cuts[k] : min(cuts[k + 1] + reach, len(text))]
                    values = [[row], [k], [len(cuts) - 1], [cuts[k + 1] - cuts[k]], [part]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, pa.string() if i == 4 else pa.int64()) for i, v in enumerate(values)],
                        names=["row", "chunk", "chunks", "size", "text"],
                    )

    return long_texts.select("row", "text").mapInArrow(split, _CHUNK)


def _scan(chunks: DataFrame, params: Params) -> DataFrame:
    """Ids of every chunk of the best paths: (row, chunk, ids)."""
    width = vocabulary(params.vocabulary).longest

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(params)
        for batch in batches:
            made = [
                transfer(encoder, text, size).tobytes()
                for text, size in zip(batch.column("text").to_pylist(), batch.column("size").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(made, pa.binary())], names=["row", "chunk", "matrix"]
            )

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        stack = np.frombuffer(b"".join(table.column("matrix").to_pylist()), dtype=np.int64).reshape(-1, width, width)
        found = boundary_states(stack)
        return pa.table({"row": table.column("row"), "chunk": table.column("chunk"), "low": found[:-1], "high": found[1:]})

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(params)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("text", "size", "low", "high")]
            spans = [text[low : size + high] for text, size, low, high in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(encoder.encode(spans), pa.binary())],
                names=["row", "chunk", "ids"],
            )

    made = chunks.select("row", "chunk", "size", "text").mapInArrow(matrices, "row long, chunk long, matrix binary")
    found = made.groupBy("row").applyInArrow(states, "row long, chunk long, low long, high long")
    return chunks.join(found, ["row", "chunk"]).select("row", "chunk", "text", "size", "low", "high").mapInArrow(
        backtrace, "row long, chunk long, ids binary"
    )


def encode(docs: DataFrame, keep: list[str], params: Params = Params(), check: bool = False) -> DataFrame:
    """The `keep` columns of every row with ids (little-endian 32-bit numbers) and the number of chunks.

    `check` adds round_trip: whether decoding the ids gives the text back. `docs` must be a stable scan or a written table:
    the rows of giant texts are numbered where they are read.
    """
    plain = docs.select(
        F.monotonically_increasing_id().alias("row"),
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)],
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    long = F.length("text") > params.chunk_chars
    kept = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    tail = [T.StructField("ids", T.BinaryType()), T.StructField("n_chunks", T.LongType())]
    tail += [T.StructField("round_trip", T.BooleanType())] if check else []
    schema = T.StructType(kept + tail)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(params)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = part.column("text").to_pylist()
                done = "ids" in part.schema.names
                ids = part.column("ids").to_pylist() if done else encoder.encode([marked(t) for t in texts])
                arrays = [part.column(f.name) for f in kept]
                arrays += [pa.array(ids, pa.binary()), part.column("n_chunks") if done else pa.array([1] * len(ids), pa.int64())]
                if check:
                    arrays.append(pa.array([encoder.decode(i) == t.replace(SPACE, " ") for i, t in zip(ids, texts)]))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
            pa.default_memory_pool().release_unused()  # a reused worker would keep what its largest batch took

    short = plain.filter(~long).mapInArrow(whole, schema)
    giant = plain.filter(long)
    chunks = cut(_chunks(giant, params))
    parts = _scan(chunks, params).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    joined = parts.select("row", F.concat(F.lit(b""), F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, b: F.concat(a, b))).alias("ids"), F.size("parts").cast("long").alias("n_chunks"))
    solved = giant.join(joined, "row")
    solved = solved.mapInArrow(whole, schema) if check else solved.select(*schema.names)
    out = short.union(solved.select(*schema.names))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *[f.name for f in tail])


def digest(encoded: DataFrame) -> DataFrame:
    """Columns of `encoded` with ids replaced by their number and checksum."""
    return encoded.withColumns(
        {"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_crc32": F.crc32("ids")}
    ).drop("ids")
