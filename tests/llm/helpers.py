"""Small tables with every awkward row, and slow plain forms of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = str.maketrans({chr(97 + i): chr(65 + i) for i in range(26)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
# names that the operators use inside
CLASHING = ("row", "n", "tokens", "_0", "_text", "score", "held_out", "size", "start", "ids", "place", "kind", "label", "pass", "rep", "kept")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta,", "the", "of", "éclair", "x1"]) + str(rng.randrange(50)) for _ in range(n))


def awkward(spark, clashing: bool = True):
    long = prose(1, 30_000)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one", "en", "b"), (5, "one", "de", "b"),
        (5, "one", "de", "b"), (None, "no id but words here", "en", "a"), (7, long, "en", "a"), (8, long + " tail", "en", "c"),
        (9, "日本語 テキスト 😀", None, "c"), (10, "same words again " * 40, "fr", None), (11, "12 34 !!", "en", "ü"),
        (12, prose(2, 60), "en", "a"), (13, prose(2, 60).translate(UPPER), "en", "a"), (14, "a\n\na\nb\na", "fr", "a"),
    ]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text) -> list[str]:
    return WORD.findall(text or "")


def shingles(text, width: int) -> frozenset:
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def near_groups(rows: list[tuple[int, str]], width: int, percent: int = 80) -> dict[int, int]:
    """Smallest reachable id of every id, by comparing everything with everything."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, one) in enumerate(sets):
        for b, two in sets[:k]:
            shared = len(one & two)
            if one and two and 100 * shared >= percent * (len(one) + len(two) - shared):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i, _ in sets}
