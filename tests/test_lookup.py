"""Tokens looked up where they are read: equal to the join, without a shuffle of tokens."""

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.functions import lookup
from tallywatch.operators import texts


@pytest.mark.parametrize("bits", [64, 2])  # with two bits nearly all hashes are equal
def test_tables_find_what_a_dictionary_finds(monkeypatch, bits):
    plain = lookup.hashes
    monkeypatch.setattr(lookup, "hashes", lambda tokens: plain(tokens) & np.uint64(2**bits - 1))
    words = [f"w{i}" for i in range(300)] + ["", "é", "語", "a" * 5000]
    table = lookup.TokenTable.of(pa.array(words), np.arange(len(words), dtype=np.int32))
    asked = ["w7", "w299", "w300", "", "語", "a" * 5000, "a" * 4999, "w7", None]
    known = {w: i for i, w in enumerate(words)}
    assert table.find(pa.array(asked, pa.string()), -1).tolist() == [known.get(w, -1) for w in asked]
    assert lookup.TokenTable.of(pa.array([], pa.string()), np.zeros(0, np.int32)).find(pa.array(["x"]), 9).tolist() == [9]


def test_hashes_differ_and_ignore_where_strings_lie():
    words = pa.array([f"{a}{b}" for a in range(300) for b in "xyz"] + ["ab", "ba", "aab", "a", "aa"])
    assert len(np.unique(lookup.hashes(words))) == len(words)
    assert lookup.hashes(words.slice(5, 7)).tolist() == lookup.hashes(words)[5:12].tolist()


ROWS = [(1, "The cat the dog"), (2, None), (3, ""), (4, "zebra CAT?"), (4, "zebra CAT?"), (5, "été cat cat cat " * 3)]


@pytest.mark.parametrize("bound", [lookup.LOOKUP_TOKENS, 0])
def test_both_ways_give_the_same_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(lookup, "LOOKUP_TOKENS", bound)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    vocabulary = texts.build_vocabulary(docs.filter("doc_id < 4"), 2)
    encoded = sorted((r.doc_id, r.input_ids, r.attention_mask) for r in texts.encode(docs, vocabulary, max_length=5).collect())
    ids = {1: [2, 3, 2, 1, 0], 2: None, 3: [0] * 5, 4: [1, 3, 0, 0, 0], 5: [1, 3, 3, 3, 1]}
    filled = {2: [0] * 5}
    assert [(i, x) for i, x, _ in encoded] == [(i, filled.get(i) or ids[i]) for i, _ in sorted(ROWS, key=lambda r: r[0])]
    assert [sum(m) for _, _, m in encoded] == [4, 0, 0, 2, 2, 5]
    described = texts.describe(docs, texts.reference_tokens(docs.filter("doc_id < 4")), keep=())
    assert sorted((r.doc_id, round(r.oov_share, 6)) for r in described.collect()) == [(1, 0), (2, 0), (3, 0), (4, 0.5), (4, 0.5), (5, 0.25)]


def test_no_token_is_shuffled(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    for made in (texts.encode(docs, texts.build_vocabulary(docs, 2)), texts.describe(docs, texts.reference_tokens(docs))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_only_what_the_most_frequent_tokens_leave_is_joined(spark, monkeypatch, tmp_path):
    rows = [(i, f"often common often rare{i} other{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vocabulary = texts.reference_tokens(docs.filter("doc_id < 20"))
    monkeypatch.setattr(lookup, "LOOKUP_TOKENS", 10)
    kept = []
    monkeypatch.setattr(texts, "stored", lambda df, purpose, plain=texts.stored: kept.append(plain(df, purpose)) or kept[-1])
    described = texts.describe(docs, vocabulary, keep=()).collect()
    assert sorted((r.doc_id, round(r.oov_share, 6)) for r in described) == [(i, 0 if i < 20 else 0.4) for i in range(40)]
    assert kept[1].selectExpr("sum(size(_rest))").first()[0] == 80  # of 200 tokens
