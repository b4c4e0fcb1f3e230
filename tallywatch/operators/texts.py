"""Vocabulary, encoding and text descriptors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.lookup import TokenTable
from tallywatch.functions.sizes import stored
from tallywatch.functions.text import attention_mask, non_letter_share, pad_ids, tokens, word_count
from tallywatch.functions.vectors import list_runs

UNSEEN = -(2**31)  # no value of a token
PAD_ID, UNKNOWN_ID, FIRST_ID = 0, 1, 2
VOCABULARY_SIZE = 30_000


def build_vocabulary(texts: DataFrame, size: int = VOCABULARY_SIZE, column: str = "text") -> DataFrame:
    """The `size` most frequent tokens (alphabetical on ties) with ids from 2 in that order."""
    # the outer form keeps Catalyst from adding a size filter that would extract the tokens twice
    each = texts.select(F.explode_outer(tokens(F.col(column))).alias("token")).filter(F.col("token").isNotNull())
    counted = each.groupBy("token").agg(F.count("*").alias("n"))
    top = counted.orderBy(F.col("n").desc(), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.col("n").desc(), "token"))
    return top.select("token", (rank + (FIRST_ID - 1)).cast("int").alias("token_id"))


def reference_tokens(texts: DataFrame, column: str = "text") -> DataFrame:
    """Every distinct token of the texts and how often it occurs."""
    each = texts.select(F.explode_outer(tokens(F.col(column))).alias("token"))
    return each.filter(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("n"))


def _looked_up(df: DataFrame, vocabulary: DataFrame, value: str, missing: int) -> DataFrame:
    """`df` with the values of its `_tokens` as `_values` in their place; tokens outside the vocabulary give `missing`.

    A vocabulary within the bounds of `TokenTable` goes to every worker once, and tokens are looked up where they are read. Of a
    larger one the most frequent tokens go there (by its column `n`, if it has one); only what they leave is joined with the
    others in a shuffle.
    """
    count = F.col("n") if "n" in vocabulary.columns else F.pmod(F.xxhash64("token"), F.lit(1024))
    known = vocabulary.filter("token IS NOT NULL").select("token", F.col(value).cast("int").alias("_value"), count.alias("_count"))
    known = stored(known, "vocabulary")  # measured, then fetched or joined
    table, rest = TokenTable.fetched(known, "_value"), None
    if table is None:
        table, rest = TokenTable.of_most_frequent(known, "_value", "_count")
    shipped = df.sparkSession.sparkContext.broadcast(table)
    others, left = [c for c in df.columns if c != "_tokens"], rest is not None
    names = [*others, "_values", *(["_at", "_rest"] if left else [])]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in list_runs(batches, "_tokens"):
            lists = batch.column("_tokens")
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            ends, words = np.concatenate([[0], np.cumsum(sizes)]), lists.flatten()
            values = shipped.value.find(words, UNSEEN if left else missing)
            more = []
            if left:
                unseen = np.flatnonzero((values == UNSEEN) & np.asarray(words.is_valid()))
                cut = pa.array(np.searchsorted(unseen, ends).astype(np.int32))
                at = unseen - np.repeat(ends[:-1], sizes)[unseen]
                more = [pa.ListArray.from_arrays(cut, x) for x in (pa.array(at.astype(np.int32)), words.take(pa.array(unseen)))]
                values[values == UNSEEN] = missing
            made = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], made, *more], names=names)

    ints = T.ArrayType(T.IntegerType())
    added = [T.StructField("_values", ints), T.StructField("_at", ints), T.StructField("_rest", T.ArrayType(T.StringType()))]
    found = df.select(*others, "_tokens").mapInArrow(find, T.StructType([*[df.schema[c] for c in others], *added[: 3 if left else 1]]))
    return _with_rest(found, rest, others) if left else found


def _with_rest(found: DataFrame, rest: DataFrame, others: list[str]) -> DataFrame:
    """Values of the tokens that the table left, put in their places."""
    kept = stored(found.withColumn("_row", F.monotonically_increasing_id()), "looked-up")  # repeated rows stay apart
    each = kept.select("_row", F.inline(F.arrays_zip("_at", "_rest"))).withColumnRenamed("_rest", "token")
    hits = each.join(rest.select("token", "_value"), "token").groupBy("_row").agg(
        F.map_from_entries(F.collect_list(F.struct("_at", "_value"))).alias("_hits")
    )
    put = F.transform("_values", lambda v, i: F.coalesce(F.try_element_at("_hits", i), v))
    values = F.when(F.col("_hits").isNull(), F.col("_values")).otherwise(put)
    return kept.join(hits, "_row", "left").select(*others, values.alias("_values"))


def encode(
    texts: DataFrame, vocabulary: DataFrame, id_column: str = "doc_id", max_length: int = 512,
    keep: tuple[str, ...] = ("label", "split"), column: str = "text",
) -> DataFrame:
    """Fixed-length token ids and their attention mask; only the id and the kept columns stay with them.

    Tokens are cut to `max_length` before their ids are looked up in the task that reads the text.
    """
    kept = [c for c in keep if c in texts.columns]
    cut = texts.select(id_column, *kept, F.slice(tokens(F.col(column)), 1, max_length).alias("_tokens"))
    ids = F.col("_values")
    return _looked_up(cut, vocabulary, "token_id", UNKNOWN_ID).select(
        id_column,
        *kept,
        pad_ids(ids, max_length, PAD_ID).alias("input_ids"),
        attention_mask(ids, max_length).alias("attention_mask"),
    )


def describe(texts: DataFrame, vocabulary: DataFrame | None = None, id_column: str = "doc_id",
             keep: tuple[str, ...] = ("split",), column: str = "text") -> DataFrame:
    """Length, word count, non-letter share and, given the reference vocabulary (all its tokens), the share of tokens outside it."""
    text = F.col(column)
    kept = [c for c in keep if c in texts.columns]
    described = texts.select(
        id_column,
        *kept,
        F.length(text).cast("bigint").alias("text_length"),
        word_count(text).alias("word_count"),
        non_letter_share(text).alias("non_letter_share"),
        *([tokens(text).alias("_tokens")] if vocabulary is not None else []),
    )
    if vocabulary is None:
        return described
    found = _looked_up(described, vocabulary.withColumn("_known", F.lit(1)), "_known", 0)
    known = F.aggregate("_values", F.lit(0), lambda acc, v: acc + v)
    share = F.coalesce(1 - F.try_divide(known.cast("double"), F.size("_values").cast("double")), F.lit(0.0))
    return found.withColumn("oov_share", share).drop("_values")
