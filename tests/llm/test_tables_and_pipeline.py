from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, empty, near_groups, prose, words
from pyspark.sql import functions as F

import corpus_pipeline
from tallywatch.llm import catalog, scratch, url_filter, vector_search
from tallywatch.llm.components import components


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 200), (200, 7), (300, 300), (None, 3)]
    rng.shuffle(edges)
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in [*range(41), 200]}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- URL filter


def page(i, url, *links):
    return i, url, "".join(f'<p><a class=x href="{link}">y</a>' for link in links)


def test_rules_and_parts_of_urls(spark):
    rows = [
        page(1, "http://A.Example.NET/en/x?q=1"), page(2, "https://example.net/de/"), page(3, "https://xexample.net"),
        page(4, "ftp://sub.example.com/de/a#b"), page(5, "https://example.org/fr/1"), page(6, "no scheme"), page(7, None),
        page(8, "http://example.com?x=/de/"), page(9, "x://y://z/p"), (10, "http://q.org/", None), page(10, "http://q.org/"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("z") for c in ("host", "path", "rule", "score")})
    found = {r.page_id: tuple(r)[1:] for r in url_filter.judge(df, catalog.URL_RULES).collect()}
    assert found[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[2] == ("example.net", "/de/", "net/", "block")
    assert found[3] == ("xexample.net", "", None, "allow")  # an empty path begins with no rule's path
    assert found[4] == ("sub.example.com", "/de/a", "example.com/de/", "block")
    assert found[5][2:] == ("org/fr/", "allow") and found[6] == ("", "", None, "allow") == found[7]
    assert found[8] == ("example.com", "", None, "allow") and found[9][:2] == ("y:", "//z/p")


def test_distrust_goes_against_links_and_trust_along(spark):
    rules = (url_filter.Rule("bad.com/", "block"), url_filter.Rule("good.com/", "allow"))
    rows = [
        page(1, "http://bad.com/"), page(2, "http://good.com/", "http://friend.com/a"), page(3, "http://friend.com/", "//BAD.com/x"),
        page(4, "http://fan.com/", "https://bad.com/1", "http://bad.com/2", "/own"), page(5, "http://other.com/", "http://fan.com"),
        page(6, "http://alone.com/"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.host: r.verdict for r in url_filter.judge(df, rules, url_filter.Params(threshold=0.4)).collect()}
    assert found == {"bad.com": "block", "good.com": "allow", "friend.com": "allow", "fan.com": "block", "other.com": "block", "alone.com": "allow"}


def test_hosts_without_pages_are_seeds(spark):
    rows = [page(1, "http://fan.com/", "http://spam.net/a", "http://x.junk.net/"), page(2, "http://plain.com/", "http://elsewhere.com/"),
            page(3, "http://part.com/", "http://example.com/de/"), page(4, "http://spam.net.com/")]
    rules = catalog.URL_RULES
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.host: r.verdict for r in url_filter.judge(df, rules, url_filter.Params(threshold=0.4)).collect()}
    assert found == {"fan.com": "block", "plain.com": "allow", "part.com": "allow", "spam.net.com": "allow"}


def test_url_filter_equals_its_oracle_with_links(spark):
    import duckdb

    rng = random.Random(4)
    hosts = [f"{a}.example.{b}" for a in ("x", "y", "z", "w") for b in ("net", "com", "org")]
    uncrawled = [f"u{i}.{b}" for i in range(4) for b in ("net", "com", "org")]  # link targets without pages
    rows = [page(i, f"https://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{i}", *[f"http://{rng.choice(hosts + uncrawled)}/" for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    expected = sorted(con.sql(catalog.ORACLES["op6_url_filter"]).select("page_id, host, path, rule, verdict").fetchall())
    assert sorted(map(tuple, url_filter.judge(df, catalog.URL_RULES).collect())) == expected


def test_trust_travels_along_many_links(spark):
    """A ring that distrust goes round many times, and a chain of 14 links: what ten rounds would leave out decides."""
    rules = (url_filter.Rule("bad.com/", "block"),)
    ring = [page(i, f"http://r{i}.com/", f"http://r{(i + 1) % 3}.com/", *(["http://bad.com/"] if i == 0 else [])) for i in range(3)]
    chain = [page(100 + i, f"http://c{i}.com/", f"http://c{i + 1}.com/" if i < 13 else "http://bad2.com/") for i in range(14)]
    df = spark.createDataFrame(ring + chain + [page(200, "http://bad.com/"), page(201, "http://bad2.com/")], "page_id long, url string, html string")
    rules += (url_filter.Rule("bad2.com/", "block"),)
    found = {r.host: r.verdict for r in url_filter.judge(df, rules, url_filter.Params(threshold=0.1, tolerance=1e-4)).collect()}
    for i in range(14):  # c13 is one link from the blocked host
        assert found[f"c{i}.com"] == ("block" if 0.85 ** (14 - i) >= 0.1 else "allow")
    # distrust of r0: 0.85 from bad.com, then a third of the ring's turns come back: 0.85 / (1 - 0.85 ** 3) in the limit
    limit = 0.85 / (1 - 0.85**3)
    params = url_filter.Params(threshold=limit - 1e-3, tolerance=1e-5)
    assert {r.host for r in url_filter.judge(df, rules, params).collect() if r.verdict == "block"} == {"bad.com", "bad2.com", "r0.com"}


def test_url_filter_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge(none, catalog.URL_RULES).collect() == []


# --- vector search


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(200)]
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan")] * 6), (203, [float("inf"), 1.0]), (204, [1.5]), (205, []), (None, [1.0] * 6), (40, [9.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("weights", "q", "c", "query", "rank")})
    good = [(i, [np.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = {}
    for own in sorted({i for i, _ in good if i % 20 == 0}):
        query = min(v for i, v in good if i == own)
        scored = [(-int(sum(a * b for a, b in zip(query, v))), i) for i, v in good if i != own]
        expected[own] = [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:5])]
    for blocks in ((4, 30), (1000, 1000)):
        params = vector_search.Params(k=5, query_rows=blocks[0], candidate_rows=blocks[1], dense_share=0.8)
        found: dict = {}
        for r in vector_search.top_k(df.filter("vec_id % 20 = 0"), df, params).collect():
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert {k: sorted(v) for k, v in found.items()} == expected
    assert vector_search.top_k(df.limit(0), df).collect() == [] == vector_search.top_k(df.filter("vec_id = 0"), df.filter("vec_id = 0")).collect()


# --- pipeline


def folder_of(spark, tmp_path, docs) -> str:
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 4 > 0), 0) for i in range(0, 60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def sample(spark):
    rows = [(i, prose(i, 80) if i % 4 else "JUNK!! | " * 40, "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100 + i, prose(i, 80) + " end", "en", "s0", 0) for i in range(1, 20) if i % 4]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_keep_columns_and_follow_their_operators(spark, tmp_path):
    extra = ("_row", "_spans", "pass", "row", "n", "kept", "label")
    docs = sample(spark).withColumns({c: F.col("doc_id") for c in extra})
    folder, (classify, rules, dedup, mix, encode) = folder_of(spark, tmp_path, docs), [f for _, f in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = classify(spark, docs, folder)
    assert good.columns == docs.columns
    ids = {r.doc_id for r in good.collect()}
    assert ids and all(i % 4 for i in ids if i < 60)
    assert {r.doc_id for r in rules(spark, docs, folder).collect()}.isdisjoint(range(0, 60, 4))
    single = dedup(spark, docs, folder)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = near_groups(rows, 5)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values())) and single.columns == docs.columns
    single.write.parquet(str(tmp_path / "single"))
    single = spark.read.parquet(str(tmp_path / "single"))
    mixed = mix(spark, single, folder)
    assert mixed.columns == docs.columns
    taken, texts = {}, dict(rows)
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words(r.text))
        assert r.n_chars == len(r.text) and r.label == r.doc_id and set(words(r.text)) <= set(words(texts[r.doc_id]))
    total = sum(len(words(t)) for i, t in rows if i in set(groups.values()))
    assert sum(taken.values()) == pytest.approx(1.5 * total, rel=0.1) and all(n <= 2 * len(words(texts[i])) for i, n in taken.items())
    assert {r.n_tokens > 0 for r in encode(spark, mixed, folder).collect()} == {True}


def test_pipeline_with_awkward_rows_and_without_rows(spark, tmp_path):
    docs = awkward(spark)
    folder = folder_of(spark, tmp_path, docs)
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "source", "n_tokens", "ids"]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        if name != "encoding":
            assert made.columns == docs.columns and {r.doc_id for r in made.collect()} <= {r.doc_id for r in docs.collect()}
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_deduplication_compares_rows_and_not_ids(spark):
    one, two = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, one, "a"), (5, one, "a"), (6, one, "b"), (5, two, "c"), (7, two, "d"), (None, "x", "e"), (None, "x", "f"), (None, two, "g"), (None, None, "h"), (8, None, "i"),
            (9, "", "j"), (None, "alone among all the others here", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    found = corpus_pipeline.STAGES[2][1](spark, docs, "")
    assert sorted(r.lang for r in found.collect()) == ["a", "c", "e", "h", "i", "j", "k"]
    assert found.filter("lang = 'c'").first().doc_id == 5


def test_few_rows_are_checkpointed_in_few_files(spark):
    """Whatever the number of shuffle partitions: each file costs an executor two processes on a local disk."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    docs = scratch.cut(spark.createDataFrame([(i, prose(i // 3, 80) + " end" * (i % 3), "en", "s", 0) for i in range(90)], sample(spark).schema))
    shared = Path(scratch._shared(spark).removeprefix("file:"))
    old = set(shared.glob("rdd-*"))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = corpus_pipeline.STAGES[2][1](spark, docs, "")
        assert sorted(r.doc_id for r in found.collect()) == list(range(0, 90, 3))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [len(list(x.glob("part-*"))) for x in set(shared.glob("rdd-*")) - old]
    assert len(files) > 10 and sum(n > 2 * spark.sparkContext.defaultParallelism for n in files) <= 1  # the members to be confirmed


@pytest.mark.parametrize("name", ["tallywatch.llm.catalog", "tallywatch.llm"])
def test_entry_works_without_the_subpackage(name):
    """With the subpackage and the pipeline gone, the other queries are all there."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        f"        if name in ({name!r}, 'corpus_pipeline'): raise ModuleNotFoundError('gone', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'A1_prediction_statistics' in e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], check=True)


def test_stages_hand_texts_to_python_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["nbytes", "n"])

    texts = spark.range(0, 300, 1, 1).select(F.repeat(F.col("id").cast("string"), 50_000).alias("text"))
    docs = empty(spark)
    before = spark.conf.get(corpus_pipeline.BATCH, None)
    spark.conf.unset(corpus_pipeline.BATCH)
    try:
        dict(corpus_pipeline.STAGES)["encoding"](spark, docs, "")
        found = texts.mapInArrow(sizes, "nbytes long, n long").collect()
        assert sum(r["n"] for r in found) == 300 and max(r["nbytes"] for r in found) < 2 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(corpus_pipeline.BATCH, "12345678")
        dict(corpus_pipeline.STAGES)["encoding"](spark, docs, "")
        assert spark.conf.get(corpus_pipeline.BATCH) == "12345678"
    finally:
        spark.conf.unset(corpus_pipeline.BATCH)
        if before is not None:
            spark.conf.set(corpus_pipeline.BATCH, before)
