"""Text expressions: word counts, hashes, term extraction, padding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Spark's default English stop words (StopWordsRemover), in their published order.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
    it its itself they them their theirs themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or because as until while of at by for with
    about against between into through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some such no nor not only
    own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
    she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
    haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could
    here's how's let's ought that's there's what's when's where's who's why's would
    """.split()
)

# A term is two or more letters, digits or underscores in any script; a token is one or more.
TERM_CHARACTER = r"[\p{L}\p{N}_]"
TERM_PATTERN = TERM_CHARACTER + "{2,}"
TOKEN_PATTERN = TERM_CHARACTER + "+"
# The whitespace of every script; a word is a run of anything else.
WHITESPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
WORD_PATTERN = f"[^{WHITESPACE}]+"
STRIP_PATTERN = f"^[{WHITESPACE}]+|[{WHITESPACE}]+$"

# Request limits on text length and batch size, feedback comment length.
MIN_TEXT_LENGTH, MAX_TEXT_LENGTH = 1, 5000
MIN_BATCH, MAX_BATCH = 1, 100
MAX_COMMENT_LENGTH = 1000


@lru_cache(maxsize=8)
def _marked_characters(application: str, pattern: str) -> bytes:
    points = SparkSession.active().range(0x110000).filter(~F.col("id").between(0xD800, 0xDFFF))
    character = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    marked = np.zeros(0x110000, dtype=bool)
    marked[points.filter(F.regexp_like(character, F.lit(pattern))).toArrow()["id"].to_numpy()] = True
    return np.packbits(marked).tobytes()


def marked_characters(spark: SparkSession, pattern: str) -> np.ndarray:
    """A bit per code point (`np.packbits`): whether Spark's regular expressions find the pattern in it. Asked once per application."""
    return np.frombuffer(_marked_characters(spark.sparkContext.applicationId, pattern), dtype=np.uint8)


def input_hash(text: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text."""
    return F.sha2(text, 256)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for an empty or missing text.

    Never NULL by type: a join or grouping on it gets no IS NOT NULL filter, which would count the words twice.
    """
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint"), F.lit(0).cast("bigint"))


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only spaces."""
    return F.regexp_replace(text, STRIP_PATTERN, "")


def preview(text: Column, width: int = 50) -> Column:
    """The first `width` characters, with an ellipsis only when the text is longer."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def tokens(text: Column) -> Column:
    """Lower-cased tokens in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def words_without_stops(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower-cased terms in text order with the stop words removed."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))
    return F.filter(found, lambda word: ~word.isin(list(stop_words)))


def with_bigrams(words: Column) -> Column:
    """The words followed by every pair of neighbouring words joined with one space; NULL for a pair with a NULL word."""
    size = F.size(words)
    firsts = F.slice(words, 1, F.greatest(size - 1, F.lit(0)))
    pairs = F.zip_with(firsts, F.slice(words, 2, F.greatest(size - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(size > 1, F.concat(words, pairs)).otherwise(words)


def pad_ids(ids: Column, max_length: int, pad_id: int = 0) -> Column:
    """Cut to `max_length` and fill with `pad_id` up to it."""
    cut = F.slice(ids, 1, max_length)
    return F.concat(cut, F.array_repeat(F.lit(pad_id), F.lit(max_length) - F.size(cut)))


def attention_mask(ids: Column, max_length: int) -> Column:
    """1 for every kept id, 0 for every padding position."""
    kept = F.least(F.size(ids), F.lit(max_length))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), F.lit(max_length) - kept))


def non_letter_share(text: Column) -> Column:
    """Share of characters that are not letters; 0 for an empty text."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce(1 - F.try_divide(letters.cast("double"), F.length(text).cast("double")), F.lit(0.0))
