"""License scan: parts of texts compared with license templates by the Dice coefficient over word bigrams.

A text that reaches the coefficient t with a template of b bigrams shares at least b * t / (2 - t) of them, so it has one of
any larger rest of the template's bigrams. Of every template such a rest is taken, the bigrams with the longest words, and
texts and units without any of those words are passed over.

A text's units are the text, its paragraphs and its lines; they and the templates are normalised (lower case, runs of other
characters than letters and digits become one space). Notices that are no unit (several paragraphs or lines of a longer text,
a part of a sentence) are found by windows over the words of the text, see `windows`. A unit and a template with n and b distinct bigrams can only reach a
coefficient t when b * t / (2 - t) <= n <= b * (2 - t) / t, which prunes units before their bigrams are looked at, and
templates for every unit. Bigrams find their templates by an equality join with the templates' bigrams, a table as large as
the list of templates; only bigrams that a template has are grouped, and they are counted before the shuffle.

`scan` compares with `TEMPLATES` and the further `FORMS`; of the forms and versions that a place matches the best by Dice
counts, so a place is one match. The SQL of `oracle` covers units and `TEMPLATES`.

Defined cases: NULL and empty texts and texts of one word match nothing; of equally good matches the template that sorts
first wins; a template of fewer than two words matches nothing; repeated rows are scanned each; an empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.license_forms import FORMS
from tallywatch.llm.scratch import cut

# Names and texts of public license notices.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
ALL: dict[str, str] = TEMPLATES | FORMS
LEAST = 0.75
BLANK = r"\n[ \t\r]*\n"  # between paragraphs
MARGIN = 0.25  # of the least score: how far a window may fall below its peak before it ends


def _split(text):
    """Words of the normalised text, with empty ones at its ends."""
    return F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " ")


def _words(text):
    return F.filter(_split(text), lambda w: w != "")


def _bigrams(words):
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def template_bigrams(spark, templates: dict[str, str]) -> DataFrame:
    """(bigram, license, b): every template's distinct bigrams, and how many it has."""
    listed = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in templates.items()])
    table = spark.range(1).select(F.inline(listed)).withColumn("words", _words(F.col("text"))).withColumn("bigrams", _bigrams(F.col("words")))
    return table.select("license", F.size("bigrams").alias("b"), F.explode("bigrams").alias("bigram"))


def anchors(known: list, least: float) -> list[str]:
    """Words of which every text that reaches the coefficient has at least one, from rows of `template_bigrams`."""
    of: dict[str, list[str]] = {}
    for row in known:
        of.setdefault(row["license"], []).append(row["bigram"])
    longest = {k: [max(b.split(" "), key=lambda w: (len(w), w)) for b in bigrams] for k, bigrams in of.items()}
    used = Counter(w for listed in longest.values() for w in set(listed))
    words = set()
    for listed in longest.values():  # of equally long words those of many templates, so the list stays short
        rest = len(listed) - ceil(len(listed) * least / (2 - least) - 1e-9) + 1
        words.update(sorted(listed, key=lambda w: (len(w), used[w], w), reverse=True)[:rest])
    return sorted(words)


def matches(docs: DataFrame, known: DataFrame, least: float = LEAST) -> DataFrame:
    """All units that reach the coefficient: (row, kind, unit, license, dice); `docs` has row and text.

    `known` has the templates' bigrams, see `template_bigrams`.
    """
    rows = known.collect()  # as many as the list of templates has bigrams
    sizes = [row["b"] for row in rows] or [0]
    low, high = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    wanted = F.array(*[F.lit(w) for w in anchors(rows, least)]).cast("array<string>")
    docs = docs.filter(F.arrays_overlap(_split(F.col("text")), wanted))
    lines, paragraphs = F.split("text", "\n"), F.split("text", BLANK)

    def units(parts, kind: str):
        made = F.transform(parts, lambda t, i: F.struct(F.lit(kind).alias("kind"), i.alias("unit"), t.alias("part")))
        return made if kind == "text" else F.when(F.size(parts) > 1, made).otherwise(F.slice(made, 1, 0))

    every = F.concat(units(F.array("text"), "text"), units(paragraphs, "paragraph"), units(lines, "line"))
    split = docs.filter("text IS NOT NULL").select("row", F.inline(every)).filter(F.arrays_overlap(_split(F.col("part")), wanted)).withColumn("words", _words(F.col("part"))).filter(F.size("words") > low)
    sized = split.select("row", "kind", "unit", _bigrams(F.col("words")).alias("bigrams")).withColumn("n", F.size("bigrams"))
    opened = sized.filter(F.col("n").between(low, high)).select("row", "kind", "unit", "n", F.explode("bigrams").alias("bigram"))
    fits = F.col("n").between(F.col("b") * least / (2 - least), F.col("b") * (2 - least) / least)
    shared = opened.join(F.broadcast(known), "bigram").filter(fits)  # as large as the list of templates
    counted = shared.groupBy("row", "kind", "unit", "license", "n", "b").agg(F.count("*").alias("common"))
    dice = (F.lit(2.0) * F.col("common")) / (F.col("n") + F.col("b"))
    return counted.select("row", "kind", "unit", "license", dice.alias("dice")).filter(F.col("dice") >= least)


def windows(docs: DataFrame, known: DataFrame, least: float = LEAST) -> DataFrame:
    """Runs of words that reach the coefficient: (row, license, start, stop, dice), in bigrams of the text, ends included.

    In a window of n bigrams, c of them the template's, 2 * c >= t * (n + b) is the same as (2 - t) * c - t * (n - c) >= t * b.
    So the window of the largest sum is sought, with 2 - t for a bigram of the template and -t for another: one pass over the
    template's bigrams in the text. A bigram that came less than b * t / (2 - t) before counts nothing. A window that reached
    the least sum ends when its sum falls by MARGIN of it, so notices one after the other are found one by one. Windows are
    then judged by distinct bigrams of the template; others count each time.
    """
    wanted = F.array(*[F.lit(w) for w in anchors(known.collect(), least)]).cast("array<string>")
    worded = docs.filter(F.arrays_overlap(_split(F.col("text")), wanted)).select("row", _words(F.col("text")).alias("words"))
    pairs = F.zip_with(
        F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words")), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    opened = worded.filter(F.size("words") > 1).select("row", F.posexplode(pairs).alias("pos", "bigram"))
    hits = opened.join(F.broadcast(known.withColumn("id", F.xxhash64("bigram"))), "bigram")  # as large as the list of templates
    enough = F.col("b") * least / (2 - least) - 1e-9
    grouped = hits.groupBy("row", "license", "b").agg(F.collect_list(F.struct("pos", "id")).alias("hits"))
    likely = grouped.filter(F.size(F.array_distinct(F.col("hits.id"))) >= enough)
    before = F.lag("pos").over(Window.partitionBy("row", "license", "id").orderBy("pos"))
    weighed = likely.select("row", "license", "b", F.inline("hits")).withColumn(
        "weight", F.when(F.col("pos") - before < enough, 0.0).otherwise(2 - least)
    )
    ordered = weighed.groupBy("row", "license", "b").agg(F.sort_array(F.collect_list(F.struct("pos", "id", "weight"))).alias("hits"))
    goal = F.col("b") * least
    place = "array<struct<start:int,stop:int>>"

    def state(score, start, last, top, stop, found):
        parts = (score.cast("double"), start.cast("int"), last.cast("int"), top.cast("double"), stop.cast("int"), found)
        return F.struct(*[p.alias(n) for p, n in zip(parts, ("score", "start", "last", "top", "stop", "found"))])

    def closed(s):  # windows near the goal are judged exactly afterwards
        return F.when(s["top"] >= 0.75 * goal, F.concat(s["found"], F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))).otherwise(s["found"])

    def step(s, hit):
        fallen = s["score"] - least * (hit["pos"] - s["last"] - 1)
        ends = (fallen <= 0) | ((s["top"] >= goal - 1e-9) & (s["top"] - fallen > MARGIN * goal))
        score = F.when(ends, 2 - least).otherwise(fallen + hit["weight"])
        higher = ends | (score >= s["top"])
        return state(
            score, F.when(ends, hit["pos"]).otherwise(s["start"]), hit["pos"], F.when(higher, score).otherwise(s["top"]),
            F.when(higher, hit["pos"]).otherwise(s["stop"]), F.when(ends, closed(s)).otherwise(s["found"]),
        )

    none = F.array().cast(place)
    begin = state(F.lit(0), F.lit(0), F.lit(-1), F.lit(0), F.lit(0), none)
    found = ordered.withColumn("places", F.aggregate("hits", begin, step, closed)).select("row", "license", "b", "hits", F.inline("places"))
    inside = F.filter("hits", lambda h: h["pos"].between(F.col("start"), F.col("stop")))
    judged = found.withColumn("inside", inside).withColumn("common", F.size(F.array_distinct(F.col("inside.id"))))
    n = F.col("stop") - F.col("start") + 1 - F.size("inside") + F.col("common")
    dice = (F.lit(2.0) * F.col("common")) / (n + F.col("b"))
    return judged.select("row", "license", "start", "stop", dice.alias("dice")).filter(F.col("dice") >= least)


def _apart(docs: DataFrame, found: DataFrame, units: DataFrame, templates: dict[str, str]) -> DataFrame:
    """The windows (row, license, dice) that count as matches of their own.

    Of windows that overlap the best stays. A window inside a unit that matches is that unit's match when it makes up half of
    the unit or more, or stands in the template as well.
    """
    best = F.sort_array(F.collect_list(F.struct((-F.col("dice")).alias("d"), "license", "start", "stop")))
    apart = lambda w, k: (w["stop"] < k["start"]) | (k["stop"] < w["start"])
    kept = F.aggregate(
        "found", F.slice("found", 1, 0),
        lambda out, w: F.when(F.forall(out, lambda k: apart(w, k)), F.concat(out, F.array(w))).otherwise(out),
    )
    chosen = found.groupBy("row").agg(best.alias("found")).select("row", F.inline(kept))
    held = units.groupBy("row").agg(F.collect_list(F.struct("kind", "unit", "license")).alias("matched"))
    normal = lambda text: F.concat(F.lit(" "), F.array_join(_words(text), " "), F.lit(" "))
    texts = docs.join(found.select("row").distinct(), "row").select("row", "text")
    parts = texts.join(held, "row").select("row", F.inline("matched"), "text").select(
        "row", "license", F.get(F.when(F.col("kind") == "text", F.array("text")).when(F.col("kind") == "line", F.split("text", "\n")).otherwise(F.split("text", BLANK)), F.col("unit")).alias("part"),
    )
    listed = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("notice")) for k, v in templates.items()])
    notices = docs.sparkSession.range(1).select(F.inline(listed)).select("license", normal(F.col("notice")).alias("notice"))
    inner = parts.join(F.broadcast(notices), "license").select("row", normal(F.col("part")).alias("part"), "notice")
    covers = inner.groupBy("row").agg(F.collect_list(F.struct("part", "notice")).alias("covers"))
    said = F.concat(F.lit(" "), F.array_join(F.slice("words", F.col("start") + 1, F.col("stop") - F.col("start") + 2), " "), F.lit(" "))
    placed = chosen.join(texts.select("row", _words(F.col("text")).alias("words")), "row").withColumn("said", said).drop("words")
    own = lambda c: F.contains(c["part"], F.col("said")) & (
        (F.length(c["part"]) <= 2 * F.length("said")) | F.contains(c["notice"], F.col("said"))
    )
    return placed.join(covers, "row", "left").filter(~F.coalesce(F.exists("covers", own), F.lit(False))).select("row", "license", (-F.col("d")).alias("dice"))


def scan(docs: DataFrame, templates: dict[str, str] = ALL, least: float = LEAST) -> DataFrame:
    """Best match of every row: (doc_id, license, dice, n_matches); license is NULL and dice 0 without any.

    `n_matches` counts units that match a template, each once, and windows apart from them. `docs` must be a stable scan or a
    written table: rows are numbered where they are read.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    narrow = numbered.select("row", "text")
    known = cut(template_bigrams(docs.sparkSession, templates))
    units = cut(matches(narrow, known, least))
    parts = units.groupBy("row", "kind", "unit").agg(F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("m"))
    more = _apart(narrow, cut(windows(narrow, known, least)), units, templates)
    found = parts.select("row", "m").union(more.select("row", F.struct((-F.col("dice")).alias("d"), "license")))
    best = found.groupBy("row").agg(F.min("m").alias("best"), F.count("*").alias("n_matches"))
    return numbered.select("row", "doc_id").join(best, "row", "left").select(
        "doc_id",
        F.col("best.license").alias("license"),
        F.coalesce(-F.col("best.d"), F.lit(0.0)).alias("dice"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
    )


def oracle(templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> str:
    """The same in DuckDB."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    words = "list_filter(string_split(lower(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> '')".format
    bigrams = "list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"
    return f"""
WITH templates(license, text) AS (VALUES {values}),
  known AS (SELECT license, {bigrams} AS tb FROM (SELECT license, {words('text')} AS words FROM templates)),
  units AS (SELECT doc_id, text AS part FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT doc_id, unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) FROM documents WHERE regexp_matches(text, '\\n[ \\t\\r]*\\n')
    UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents WHERE contains(text, chr(10))),
  sized AS (SELECT doc_id, {bigrams} AS ub FROM (SELECT doc_id, {words('part')} AS words FROM units)),
  pairs AS (SELECT doc_id, license, len(list_intersect(ub, tb)) AS common, len(ub) AS n, len(tb) AS b FROM sized, known
    WHERE len(ub) > 0 AND len(ub) BETWEEN len(tb) * {least} / (2 - {least}) AND len(tb) * (2 - {least}) / {least}),
  hits AS (SELECT doc_id, license, CAST(2 * common AS DOUBLE) / (n + b) AS dice FROM pairs WHERE CAST(2 * common AS DOUBLE) / (n + b) >= {least}),
  best AS (SELECT doc_id, min(struct_pack(d := -dice, l := license)) AS m, count(*) AS n_matches FROM hits GROUP BY doc_id)
SELECT doc_id, m.l AS license, coalesce(-m.d, 0.0::DOUBLE) AS dice, coalesce(n_matches, 0) AS n_matches
FROM documents LEFT JOIN best USING (doc_id)"""
