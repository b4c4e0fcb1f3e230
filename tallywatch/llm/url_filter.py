"""URL filter: host and path rules, and propagation over the link graph for pages that no rule fits.

A rule is a host with a path prefix and a verdict; it fits its host and all subdomains when the path starts with the prefix,
and of several the longest wins. Hosts are seeds by the share of their pages that rules allow (trust) or block (distrust).
Trust follows links (personalised PageRank), distrust goes against them, so a host that links to blocked hosts earns it.
A host is blocked when its distrust exceeds its trust by `threshold` or more, counted in whole seeds; its pages that no rule fits
follow the host. Hosts that are only link targets have no pages to count; a rule for the whole host makes them whole seeds.

Links are absolute or protocol-relative `href` values; links inside a host carry nothing. Everything is a DataFrame
expression; the rules, a list of moderate length, are matched where the pages are read. Counting per host and per edge is
combined before the shuffle, and the last join, with blocked hosts, can be split, so one host may own most pages.

Defined cases: a NULL url or one without `://` has empty host and path, no rule and is allowed; NULL html has no links;
rounds end when what is still to come cannot bring any host over the threshold, or when four of them moved no score by more
than `tolerance`; repeated rows are judged alike and count as pages of their own; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.scratch import written

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


ROUNDS_A_JOB = 4  # rounds between two written tables of scores


@dataclass(frozen=True)
class Rule:
    pattern: str  # host/path prefix
    verdict: str  # allow or block

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class Params:
    damping: float = 0.85
    tolerance: float = 1e-9
    threshold: float = 0.5


def _lower(column):
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def addressed(pages: DataFrame) -> DataFrame:
    """`pages` with host and path of their url."""
    host = _lower(F.regexp_extract("url", URL, 1))
    path = F.regexp_extract("url", URL, 2)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def _ruled(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Pages with the rule that wins and its verdict, NULL when none fits; the rules are part of the expression."""
    listed = F.array(
        *[
            F.struct(
                F.lit(len(r.pattern)).alias("length"), F.lit(r.pattern).alias("rule"), F.lit(r.host).alias("host"),
                F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict"),
            )
            for r in rules
        ]
    )
    host, path = F.col("host"), F.col("path")
    under = lambda r: (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))
    won = F.array_max(F.filter(listed, lambda r: under(r) & F.startswith(path, r["path"])))
    return pages.withColumn("_won", won).select(
        *pages.columns, F.col("_won.rule").alias("rule"), F.col("_won.verdict").alias("rule_verdict")
    )


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts: (source, target, n)."""
    links = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    pairs = pages.filter("host <> ''").select(F.col("host").alias("source"), links.alias("to"))
    return pairs.select("source", _lower("to").alias("target")).filter("source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, params: Params) -> DataFrame:
    """Trust and distrust of every host they reach: (host, kind, score); a lone seed of weight 1 scores 1."""
    out = edges.groupBy("source").agg(F.sum("n").alias("all_out"))
    into = edges.groupBy("target").agg(F.sum("n").alias("all_in"))
    full = edges.join(out, "source").join(into, "target")
    steps = written(
        full.select(F.col("source").alias("host"), F.lit("trust").alias("kind"), F.col("target").alias("to"), (F.col("n") / F.col("all_out")).alias("part"))
        .union(full.select("target", F.lit("distrust"), "source", F.col("n") / F.col("all_in"))),
        "link-steps",
    )
    scores = seeds
    while True:
        new = scores
        for _ in range(ROUNDS_A_JOB):
            moved = new.join(steps, ["host", "kind"]).select(F.col("to").alias("host"), "kind", (F.col("score") * F.col("part") * params.damping).alias("score"))
            new = seeds.union(moved).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        new = written(new, "host-scores")
        change = new.withColumnRenamed("score", "new").join(scores, ["host", "kind"], "left").select(
            F.abs(F.col("new") - F.coalesce("score", F.lit(0.0))).alias("moved")
        ).agg(F.max("moved").alias("most"), F.sum("moved").alias("all")).first()
        scores = new
        if (change["most"] or 0.0) <= params.tolerance:
            return scores
        # what later rounds add to all hosts together: every four carry at most damping ** 4 of what the last four moved
        to_come = change["all"] * params.damping**ROUNDS_A_JOB / (1 - params.damping**ROUNDS_A_JOB)
        nearest = surplus(scores).agg(F.min(F.abs(F.col("surplus") - params.threshold))).first()[0]
        if to_come + 1e-8 < min(nearest, params.threshold):
            return scores


def surplus(scores: DataFrame) -> DataFrame:
    """Distrust minus trust of every host, settled so that the order of summing does not decide at the threshold."""
    signed = F.when(F.col("kind") == "distrust", F.col("score")).otherwise(-F.col("score"))
    return scores.groupBy("host").agg(F.round(F.sum(signed), 9).alias("surplus"))


def judge(pages: DataFrame, rules: tuple[Rule, ...], params: Params = Params()) -> DataFrame:
    """Verdict of every page: (page_id, host, path, rule, verdict)."""
    placed = addressed(pages)
    ruled = _ruled(placed.select("page_id", "host", "path"), rules)
    counts = ruled.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count(F.when(F.col("rule_verdict") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("blocked"),
    )
    kinds = F.inline(
        F.array(
            F.struct(F.lit("trust").alias("kind"), (F.col("allowed") / F.col("pages")).alias("score")),
            F.struct(F.lit("distrust").alias("kind"), (F.col("blocked") / F.col("pages")).alias("score")),
        )
    )
    edges = written(host_edges(placed.select("host", "html")), "host-edges")
    linked = edges.select(F.col("target").alias("host"), F.lit("/").alias("path")).distinct().join(counts.select("host"), "host", "left_anti")
    kind = F.when(F.col("rule_verdict") == "allow", "trust").otherwise("distrust").alias("kind")
    uncrawled = _ruled(linked, rules).filter("rule_verdict IS NOT NULL").select("host", kind, F.lit(1.0).alias("score"))
    seeds = written(counts.select("host", kinds).filter("score > 0").union(uncrawled), "seeds")
    scores = propagate(edges, seeds, params)
    bad = surplus(scores).filter(F.col("surplus") >= params.threshold)
    out = ruled.join(bad.select("host", F.lit("block").alias("host_verdict")), "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"))


def oracle(rules: tuple[Rule, ...], params: Params = Params()) -> str:
    """The same in DuckDB, with as many rounds written out as it takes until a seed's score has faded to the tolerance."""
    n_rounds = math.ceil(math.log(params.tolerance) / math.log(params.damping))
    values = ", ".join(f"('{r.host}', '{r.path}', '{r.pattern}', '{r.verdict}')" for r in rules)
    up, low = string.ascii_uppercase, string.ascii_lowercase
    url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    link = LINK.replace("'", "''")
    rounds = "".join(
        f""",
  s{k} AS (SELECT host, kind, sum(score) AS score FROM (
    SELECT * FROM seeds UNION ALL
    SELECT p."to", p.kind, s.score * p.part * {params.damping} FROM s{k - 1} s JOIN steps p ON s.host = p.host AND s.kind = p.kind
  ) GROUP BY host, kind)"""
        for k in range(1, n_rounds + 1)
    )
    return f"""
WITH rules(rhost, rpath, rule, verdict) AS (VALUES {values}),
  placed AS (SELECT page_id, html, coalesce(translate(regexp_extract(url, '{url}', 1), '{up}', '{low}'), '') AS host,
    coalesce(regexp_extract(url, '{url}', 2), '') AS path FROM pages),
  ruled AS (SELECT p.page_id, p.host, p.path,
    (SELECT max(struct_pack(l := length(r.rule), rule := r.rule, verdict := r.verdict)) FROM rules r
      WHERE (p.host = r.rhost OR p.host LIKE '%.' || r.rhost) AND starts_with(p.path, r.rpath)) AS won FROM placed p),
  counts AS (SELECT host, count(*) AS pages, count(*) FILTER (won.verdict = 'allow') AS allowed,
    count(*) FILTER (won.verdict = 'block') AS blocked FROM ruled WHERE host <> '' GROUP BY host),
  links AS (SELECT host AS source, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), '{up}', '{low}') AS target
    FROM placed WHERE host <> ''),
  edges AS (SELECT source, target, count(*) AS n FROM links WHERE source <> target GROUP BY source, target),
  uncrawled AS (SELECT t.host, (SELECT max(struct_pack(l := length(r.rule), rule := r.rule, verdict := r.verdict)) FROM rules r
      WHERE (t.host = r.rhost OR t.host LIKE '%.' || r.rhost) AND r.rpath = '/') AS won
    FROM (SELECT DISTINCT target AS host FROM edges WHERE target NOT IN (SELECT host FROM counts)) t),
  seeds AS (SELECT host, 'trust' AS kind, allowed / pages AS score FROM counts WHERE allowed > 0
    UNION ALL SELECT host, 'distrust', blocked / pages FROM counts WHERE blocked > 0
    UNION ALL SELECT host, CASE won.verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END, 1.0 FROM uncrawled WHERE won IS NOT NULL),
  steps AS (SELECT source AS host, 'trust' AS kind, target AS "to", n / sum(n) OVER (PARTITION BY source) AS part FROM edges
    UNION ALL SELECT target, 'distrust', source, n / sum(n) OVER (PARTITION BY target) FROM edges),
  s0 AS (SELECT * FROM seeds){rounds},
  bad AS (SELECT host FROM s{n_rounds} GROUP BY host
    HAVING round(sum(CASE kind WHEN 'distrust' THEN score ELSE -score END), 9) >= {params.threshold})
SELECT page_id, host, path, won.rule AS rule,
  coalesce(won.verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' END, 'allow') AS verdict FROM ruled"""
