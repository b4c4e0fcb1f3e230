"""Looking tokens up in a vocabulary within the task that reads them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOOKUP_TOKENS = 2_000_000  # a table within both bounds takes some 60 MB in a Python worker
LOOKUP_BYTES = 32_000_000

_BYTE = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def hashes(tokens: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string, from its bytes and their places."""
    if not len(tokens):
        return np.zeros(0, dtype=np.uint64)
    tokens = tokens.cast(pa.large_string())
    offsets = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
    sizes = np.diff(offsets)
    out = sizes.astype(np.uint64) * _STEP
    full = np.flatnonzero(sizes)
    if len(full):
        data = np.frombuffer(tokens.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        starts = (offsets[:-1] - offsets[0])[full]
        place = np.arange(len(data)) - np.repeat(starts, sizes[full])
        power = np.multiply.accumulate(np.full(int(sizes.max()), _STEP))
        out[full] += np.add.reduceat(_BYTE[data] * power[place], starts)
    return out ^ (out >> np.uint64(29))


@dataclass(frozen=True)
class TokenTable:
    """Tokens in the order of their hashes, with a number each."""

    keys: np.ndarray
    tokens: pa.Array
    values: np.ndarray

    @classmethod
    def of(cls, tokens: pa.Array, values: np.ndarray) -> TokenTable:
        keys = hashes(tokens)
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], tokens.take(pa.array(order)), values[order])

    @classmethod
    def fetched(cls, vocabulary: DataFrame, value: str) -> TokenTable | None:
        """The table of the `token` column with the values of another; None when it is over the bounds."""
        size = vocabulary.agg(F.count("token"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0))).first()
        if size[0] > LOOKUP_TOKENS or size[1] > LOOKUP_BYTES:
            return None
        table = vocabulary.filter("token IS NOT NULL").select("token", F.col(value).cast("int").alias("value")).toArrow()
        return cls.of(table["token"].cast(pa.string()).combine_chunks(), table["value"].to_numpy())

    @classmethod
    def of_most_frequent(cls, vocabulary: DataFrame, value: str, count: str) -> tuple[TokenTable, DataFrame]:
        """The table of as many of the most frequent tokens as are within the bounds, and the other tokens."""
        sizes = vocabulary.groupBy(count).agg(F.count("token").alias("tokens"), F.sum(F.octet_length("token")).alias("bytes"))
        order = Window.orderBy(F.col(count).desc())  # one row per count
        running = sizes.select(count, F.sum("tokens").over(order).alias("tokens"), F.sum("bytes").over(order).alias("bytes"))
        least = running.filter((F.col("tokens") <= LOOKUP_TOKENS) & (F.col("bytes") <= LOOKUP_BYTES)).agg(F.min(count)).first()[0]
        often = F.lit(False) if least is None else F.col(count) >= least
        table = vocabulary.filter(often).select("token", F.col(value).cast("int").alias("value")).toArrow()
        return cls.of(table["token"].cast(pa.string()).combine_chunks(), table["value"].to_numpy()), vocabulary.filter(~often)

    def find(self, tokens: pa.Array, missing: int) -> np.ndarray:
        """The value of every token, `missing` where there is none; equal hashes are told apart by the tokens themselves."""
        coded = tokens.dictionary_encode()
        distinct = coded.dictionary
        wanted = hashes(distinct)
        value = np.full(len(wanted) + 1, missing, dtype=np.int32)  # the last one is that of NULL
        at = np.searchsorted(self.keys, wanted)
        todo = np.arange(len(wanted))
        while len(todo):
            todo = todo[at[todo] < len(self.keys)]
            todo = todo[self.keys[at[todo]] == wanted[todo]]
            same = pc.equal(self.tokens.take(pa.array(at[todo])), distinct.take(pa.array(todo)).cast(self.tokens.type))
            same = same.to_numpy(zero_copy_only=False).astype(bool)
            value[todo[same]] = self.values[at[todo[same]]]
            todo = todo[~same]
            at[todo] += 1
        return value[coded.indices.fill_null(len(wanted)).to_numpy(zero_copy_only=False)]
