from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, empty, near_groups, prose, shingles, words
from pyspark.sql import functions as F

from tallywatch.llm import language_id, licenses, mixing, near_dedup, piece_codec, quality_classifier, quality_rules, token_files
from tallywatch.llm import lattice as L
from tallywatch.llm import words as W


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# --- words


def test_words_of_runs_equal_a_regular_expression():
    texts = ["", " a", "b ", "c\x0bd\te", "é\u00a0ü x", "\n\n", "long " * 1000, "x"]
    for run_bytes in (1, 10, 1 << 20):
        at = 0
        for run in W.runs(pa.array(texts + [None]), run_bytes):
            start, end, row = run.words()
            raw = run.data.tobytes()
            found = [[] for _ in range(run.n)]
            for a, b, r in zip(start, end, row):
                found[r].append(raw[a:b].decode())
            assert found == [words(t) for t in (texts + [None])[at : at + run.n]]
            at += run.n
        assert at == len(texts) + 1


def test_span_hashes_do_not_depend_on_place(monkeypatch):
    one = np.frombuffer(b"word and " + b"x" * 50 + b" word", dtype=np.uint8)
    start, end = np.array([0, 5, 9, 60]), np.array([4, 8, 59, 64])
    hashes = W.span_hashes(one, start, end)
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3


# --- language id


def test_forward_sums_all_segmentations():
    vocab = L.vocabulary(language_id.Params().vocabulary)
    rng = np.random.default_rng(0)
    logs = np.log(rng.dirichlet(np.ones(vocab.size + 1), 2).T)

    def plain(text: str, k: int) -> float:
        total = [1.0] + [0.0] * len(text)
        ids = {s.decode(): i for i, s in enumerate(vocab.surfaces) if s and not (3 <= i < 259)}
        for end in range(1, len(text) + 1):
            for begin in range(max(0, end - vocab.longest), end):
                piece = ids.get(text[begin:end].replace(L.SPACE, " "), vocab.size if end - begin == 1 else None)
                if piece is not None:
                    total[end] += total[begin] * np.exp(logs[piece, k])
        return np.log(total[-1])

    units = [L.SPACE + "there", "ab", "\u0d85x", L.SPACE + "language"]
    got = L.Lattice(vocab, units).scores(logs)
    assert np.allclose(got, [[plain(u, k) for k in range(2)] for u in units])


def test_cut_units_change_no_sum_and_no_path():
    vocab = L.vocabulary(language_id.Params().vocabulary)
    rng = np.random.default_rng(4)
    logs = np.log(rng.random((vocab.size + 1, 3)))
    chinese = "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 3000, 300))
    units = [L.SPACE + chinese, L.SPACE + "antidisestablishmentarianism" * 4 + chinese[:40], "short", L.SPACE + "日本語テキスト" * 20]
    for block in (1 << 16, 50):
        parts, owner = L.cut_units(vocab, units, block=block)
        assert ["".join(p for p, o in zip(parts, owner) if o == i) for i in range(len(units))] == units and len(parts) > 100
        sums = np.stack([np.bincount(owner, c) for c in L.Lattice(vocab, parts).scores(logs).T], axis=1)
        assert np.allclose(sums, L.Lattice(vocab, units).scores(logs))
        paths = L.Lattice(vocab, parts).best()
        for i, whole in enumerate(L.Lattice(vocab, units).best()):
            assert np.array_equal(np.concatenate([p for p, o in zip(paths, owner) if o == i]), whole)


def test_text_without_spaces_costs_no_more_than_words():
    import time

    rng = np.random.default_rng(5)
    texts = ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 5000, 60_000)), " ".join(prose(i, 50) for i in range(250))[:60_000]]
    encoder, spent = piece_codec.Encoder(piece_codec.Params()), []
    encoder.encode([piece_codec.marked("warm")])
    for text in texts:
        began = time.process_time()
        encoder.encode([piece_codec.marked(text)])
        spent.append(time.process_time() - began)
    assert spent[0] < 3  # 13 s before units were cut


def test_ids_of_known_pieces_take_no_step_per_unit(monkeypatch):
    encoder, single = piece_codec.Encoder(piece_codec.Params()), []
    step = piece_codec.Encoder._ids
    monkeypatch.setattr(piece_codec.Encoder, "_ids", lambda self, unit, pieces: single.append(unit) or step(self, unit, pieces))
    odd = [f"x{i}\U0001f9ff" for i in range(3)]
    text = prose(7, 2_000) + " " + " ".join(odd)
    ids = encoder.encode([piece_codec.marked(text), ""])
    assert encoder.decode(ids[0]) == text and ids[1] == b""
    assert sorted(single) == ["▁" + unit for unit in odd]
    units = ["a" * n for n in (5, 1, 70, 0, 33, 9, 9, 12, 2, 400, 30)]
    order, plain = sorted(range(len(units)), key=lambda i: len(units[i])), []
    for i in order:
        if not plain or sum(len(units[k]) for k in plain[-1]) + len(units[i]) > 60 or len(units[i]) > 4 * len(units[plain[-1][0]]) + 8:
            plain.append([])
        plain[-1].append(i)
    assert list(L.in_batches(units, 60)) == plain and list(L.in_batches([])) == []


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.fit(docs)
    found = language_id.predict(docs, model, ["doc_id", "_0"]).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {1, 2, 3, 11}
    none = language_id.predict(docs, language_id.fit(empty(spark)), ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language_id.predict(empty(spark), model, ["doc_id"]).collect() == []


def test_language_of_held_out_texts(spark, small):
    from tallywatch.llm.catalog import op1_language_id

    found = op1_language_id(spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97


# --- license scan


def test_license_scan_finds_wrapped_and_changed_notices(spark):
    mit = licenses.TEMPLATES["MIT-text"].replace(" of this software", "\nof this software").replace("Software", "Program", 2)
    rows = [(1, "intro\n\n" + mit + "\n\nend"), (2, "Licensed under the Apache License, version 2.0"), (3, "of the of the"), (4, None), (5, ""), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "license", "n", "unit")})
    found = licenses.scan(df).collect()
    assert len(found) == 6
    best = {r.doc_id: r for r in found}
    assert best[1].license == "MIT-text" and 0.8 < best[1].dice < 1 and best[2].license == "Apache-2.0" and best[2].dice == 1
    assert [best[i].license for i in (3, 4, 5)] == [None] * 3 and best[4].dice == 0 and best[4].n_matches == 0
    assert licenses.scan(empty(spark)).collect() == []


def laid_out(text: str, width: int, indent: str = "") -> str:
    import textwrap

    return "\n".join(textwrap.wrap(text, width, initial_indent=indent, subsequent_indent=indent))


def test_license_scan_finds_notices_that_are_no_unit(spark):
    code = "\n".join(f"def f{i}(x): return x + {i}" for i in range(40))
    mit, gpl, apache = (licenses.TEMPLATES[k] for k in ("MIT-text", "GPL-3.0-header", "Apache-2.0-header"))
    cuts = mit.index("The above"), mit.index("THE SOFTWARE IS")
    usual = "\n\n".join(laid_out(p, 70) for p in (mit[: cuts[0]], mit[cuts[0] : cuts[1]], mit[cuts[1] :]))
    three = "\n#\n".join(laid_out(p, 60, "# ") for p in (gpl[:290], gpl[290:560], gpl[560:]))
    rows = [
        (1, "Copyright 2020 A. Person\n\n" + usual + "\n\n" + code), (2, three + "\n" + code), (3, code + "\n" + laid_out(apache, 50, "// ") + "\n" + code),
        (4, "The code is released under the MIT License, see the file for what else there is to know"),
        (5, code), (6, usual + "\n\n" + code + "\n\n" + usual), (7, "Released under the MIT License."),
        (8, "of the software in the software and the of this software " * 50),
        (9, code + "\nParts are licensed under CC BY-NC 4.0 as well, and all the other parts are released under the MIT License as it is"),
    ]
    found = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: r.license for i, r in found.items()} == {
        1: "MIT-text", 2: "GPL-3.0-header", 3: "Apache-2.0", 4: "MIT", 5: None, 6: "MIT-text", 7: "MIT", 8: None, 9: "CC-BY-NC-4.0",
    }
    assert all(found[i].dice > 0.9 for i in (1, 2, 3, 4, 6, 7, 9))
    assert [found[i].n_matches for i in (1, 2, 4, 5, 6, 7, 9)] == [1, 1, 1, 0, 2, 1, 2]


def test_license_versions_and_forms_by_name(spark):
    texts = {
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "AGPL-3.0-header": licenses.ALL["AGPL-3.0-header"], "BSD-2-Clause-text": licenses.ALL["BSD-2-Clause-text"],
        "BSD-3-Clause-text": licenses.ALL["BSD-3-Clause-text"].replace("copyright holder nor", "University nor"),
        "CC-BY-3.0-short": "Licensed under CC BY 3.0.", "CC0-1.0": "This work is released under CC0 1.0 Universal.",
        "GPL-2.0-full": licenses.ALL["GPL-2.0-full"].replace("Everyone", "Anyone"), "MPL-2.0-full": licenses.ALL["MPL-2.0-full"],
        "Apache-2.0-full": licenses.ALL["Apache-2.0-full"].split("APPENDIX")[0],
    }
    rows = list(enumerate(texts.values()))
    found = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [found[i].license for i in range(len(rows))] == list(texts)


# --- quality classifier


def test_scores_equal_a_plain_form():
    """The attention-weighted score of each text, passage by passage in plain Python."""
    rng = np.random.default_rng(8)
    bags = [rng.normal(size=(n, quality_classifier.FEATURES)) for n in (1, 3, 2, 5) * 10]
    labels = np.array([float(b[:, 0].max() > 0.5) for b in bags])
    model = quality_classifier.train(bags, labels, quality_classifier.Params(epochs=3))
    w = model.weights
    found = model.score(np.concatenate(bags), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), len(bags))
    for bag, score in zip(bags, found):
        encoded = [np.tanh(w["encode0"] + sum(((x - m) / s) * row for x, m, s, row in zip(p, model.middle, model.scale, w["encode"]))) for p in bag]
        gates = [np.exp(np.dot(np.tanh(h @ w["view"] + w["view0"]) / (1 + np.exp(-(h @ w["gate"] + w["gate0"]))), w["attend"])) for h in encoded]
        bag_code = sum(g * h for g, h in zip(gates, encoded)) / sum(gates)
        assert score == pytest.approx(float((1 / (1 + np.exp(-(bag_code @ w["score"] + w["score0"])))).item()), abs=1e-9)


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    params = quality_classifier.Params(encoded=4, gated=3, epochs=0)
    bags = [rng.normal(size=(k, quality_classifier.FEATURES)) for k in (1, 3, 2)]
    label = np.array([1.0, 0.0, 1.0])
    weights = {k: rng.normal(0, 0.3, v.shape) for k, v in quality_classifier.train(bags, label, params).weights.items()}
    x, sizes = np.concatenate(bags), np.array([1, 3, 2])
    first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(3), sizes)

    def loss(w):
        p = 1 / (1 + np.exp(-quality_classifier._forward(w, x, first, owner)["logit"]))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    for name, grad in quality_classifier._gradient(weights, x, first, owner, label).items():
        at = tuple(int(rng.integers(s)) for s in weights[name].shape)
        up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert grad[at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_attention_sums_to_one_and_passages_cover_texts():
    run = next(W.runs(pa.array(["", prose(1, 200), "x"])))
    features, owner = quality_classifier.passages(run, 64)
    assert np.bincount(owner).tolist() == [1, 4, 1]
    kinds = features[:, : quality_classifier._KINDS].sum(axis=1)
    assert kinds[0] == 0 and np.allclose(kinds[1:], 1)


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(7, 1), (8, 1), (10, 0), (12, 0), (12, 1), (None, 1), (4, None)], "doc_id long, label int")
    model = quality_classifier.fit(docs, labels)
    found = quality_classifier.predict(docs, model, ["doc_id", "label"]).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    unlearned = quality_classifier.fit(empty(spark), labels.limit(0))
    assert {r.score for r in quality_classifier.predict(docs, unlearned, ["doc_id"]).collect()} == {0.5}
    assert quality_classifier.predict(empty(spark), model, ["doc_id"]).collect() == []


def test_quality_of_held_out_texts(spark):
    from tallywatch.llm.catalog import op3_quality_classifier

    folder = "/root/testdata/sf0.01"
    found = op3_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    held = [r for r in found.collect() if r.held_out]
    assert len(held) > 80 and np.mean([r.predicted == r.quality for r in held]) > 0.95


# --- near-duplicates


@pytest.mark.parametrize("leaf", [4, 1024])
def test_near_groups_equal_brute_force(spark, leaf):
    """Families of copies, near copies around the threshold, and a passage that all share; small leaves force branching."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for family in range(8):
        base = passage + [rng.choice(vocabulary) for _ in range(60)]
        for copy in range(14):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                text[rng.randrange(25, len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(near_dedup.near_duplicates(df, near_dedup.Params(width=4, leaf=leaf)))
    expected = near_groups(rows, 4)
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(dict(rows)[i], 4)) for i, r in found.items())


def test_near_duplicates_of_awkward_rows(spark):
    found = near_dedup.near_duplicates(awkward(spark), near_dedup.Params(width=4)).collect()
    assert len(found) == 15 and found[0].__fields__ == ["doc_id", "n_shingles", "component_id", "kept"]
    group = {r.doc_id: r.component_id for r in found}
    assert group == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11, 12: 12, 13: 12, 14: 14}
    assert {r.doc_id for r in found if r.n_shingles == 0} == {1, 2, 3}
    assert near_dedup.near_duplicates(empty(spark)).collect() == []


# --- mixing


def plain_targets(sizes: dict, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = goal - sum(2 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[o] for o in names if o not in capped) for s in names if s not in capped}
        over = {s for s, t in share.items() if t >= 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_mix_meets_targets_and_limits(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.lit("hot")).otherwise(F.col("source")))
    params = mixing.Params(block_words=16, shard_slots=64)
    mixed = mixing.mix(docs, params)
    rows = mixing.taken(mixed).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    expected = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
    assert all(abs(taken[s] - t) <= 16 + 0.01 * t for s, t in expected.items())
    again = {r.doc_id: r.taken for r in mixing.taken(mixing.mix(docs, params)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_no_block_is_taken_twice_in_a_pass():
    for n in (1, 2, 7, 1000):
        assert sorted(mixing._permuted(np.arange(n), n, 5)) == list(range(n))


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    found = mixing.taken(mixing.mix(docs, mixing.Params(block_words=8))).collect()
    assert len(found) == 15 and all(r.taken <= 2 * r.size for r in found)
    assert {r.doc_id for r in found if r.size == 0} == {1, 2, 3}
    assert mixing.taken(mixing.mix(empty(spark))).collect() == []


# --- quality rules


def test_base_features_equal_plain_ones():
    texts = ["", "a b c d e a b c d e x", "l1\nl1\n\n \nl1", "#*$ %&|<> é" * 3, prose(3, 500), "a a a a a a", "one\ntwo\r\none"]
    found = quality_rules._base(next(W.runs(pa.array(texts))))
    for i, text in enumerate(texts):
        w = words(text)
        seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {p for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines, again = set(), 0
        for line in text.split("\n"):
            if words(line):
                again += line in lines
                lines.add(line)
        plain = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered))
        assert tuple(int(found[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain


def test_references_are_exact_counts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(7)
    refs = quality_rules.references(docs)
    limits = quality_rules.Limits()
    for name, shares in zip(refs.languages, refs.words):
        counts = Counter(w.lower() if w.isascii() else w for r in docs.filter(F.col("lang") == name).collect() for w in words(r.text))
        common = sorted(n / sum(counts.values()) for w, n in counts.items() if n >= limits.common_share * sum(counts.values()))
        assert len(common) == pytest.approx((shares[:-1] > 0).sum(), abs=1)
        assert max(common) == pytest.approx(shares[:-1].max())
        assert shares.sum() == pytest.approx(1)


def test_jensen_shannon_distance():
    p = np.array([[1.0, 0.0], [0.5, 0.5], [0.0, 1.0]])
    assert quality_rules._js(p, np.array([0.5, 0.5])) == pytest.approx([0.557923, 0, 0.557923], abs=1e-6)
    assert quality_rules._js(p[:1], np.array([0.0, 1.0])) == pytest.approx([1.0])


def test_rules_on_awkward_rows(spark):
    docs = awkward(spark)
    refs = quality_rules.references(docs)
    found = quality_rules.judge(docs, refs, keep=["doc_id", "n"]).collect()
    assert len(found) == 15 and {r.doc_id for r in found if r.base_failed} >= {1, 2, 3, 4, 5, 10}
    assert quality_rules.judge(docs, refs, only_kept=True).columns == docs.columns
    nothing = quality_rules.references(empty(spark))
    assert all(r.kept != r.base_failed for r in quality_rules.judge(docs, nothing, keep=["doc_id"]).collect())


def spoken(words_: list[str], seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words_[:12]) if rng.random() < 0.4 else rng.choice(words_[12:]) + rng.choice(words_[12:]) for _ in range(n))


LATIN = "the of and to in is that it was for on with river stone garden letter winter market silver mountain window paper".split()
GREEK = "και του της το να με για από στο που δεν είναι θάλασσα βουνό δρόμος σπίτι χρόνος κόσμος λόγος ήλιος".split()


def judged(spark, rows: list[tuple]) -> dict:
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return by_id(quality_rules.judge(docs, quality_rules.references(docs)))


def test_texts_of_small_languages_are_kept(spark):
    """A language below 0.1% of all words, once with words enough for a reference and once without."""
    english = [(i, spoken(LATIN, i, 20_000), "en") for i in range(120)]
    greek = [(1000 + i, spoken(GREEK, i, 700), "el") for i in range(3)]
    assert all(r.kept for r in judged(spark, english + greek).values())
    assert all(r.kept for r in judged(spark, english + greek[:1]).values())


def test_texts_without_common_words_are_dropped_whatever_the_languages(spark):
    rng = random.Random(9)
    english = [(i, spoken(LATIN, i, 300), "en") for i in range(100)]
    unspaced = [(1000 + i, " ".join("".join(rng.choice("日本語漢字学校時間") for _ in range(30)) for _ in range(60)), "ja") for i in range(40)]
    random_letters = [(2000 + i, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(80)), "en") for i in range(2)]
    found = judged(spark, english + unspaced + random_letters)
    assert {i for i, r in found.items() if not r.kept} == {2000, 2001}


# --- piece encoding


@pytest.fixture(scope="module")
def unigram():
    """The library's own best-path encoder over the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    vocab = L.vocabulary(piece_codec.Params().vocabulary)
    model = proto.ModelProto()
    with open(piece_codec.Params().vocabulary, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    for i, piece in enumerate(model.pieces):
        piece.score = float(vocab.scores[i] / 1e6) if piece.type == 1 else 0.0
    return vocab, sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def path_score(vocab, ids) -> int:
    return sum(int(vocab.scores[i]) for i in ids)


def test_best_paths_equal_the_library(unigram, spark, small):
    vocab, library = unigram
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    texts += ["a  b   c", "  x", "a\n\nb", "日本語😀 x\ty", "", " "]
    encoder = piece_codec.Encoder(piece_codec.Params())
    for text, raw in zip(texts, encoder.encode([piece_codec.marked(t) for t in texts])):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == library.encode(text) or abs(path_score(vocab, ids) - path_score(vocab, library.encode(text))) <= 5
        assert encoder.decode(raw) == text


def test_parallel_scan_equals_one_piece(unigram):
    vocab, _ = unigram
    encoder, rng = piece_codec.Encoder(piece_codec.Params()), random.Random(5)
    for trial in range(40):
        kinds = ["the", "ing", " ", "\n", "er", "é", "日", "  ", "ation"] if trial % 2 else list("theiongr")
        text = piece_codec.marked("".join(rng.choice(kinds) for _ in range(rng.randint(30, 300))))
        size = rng.choice([20, 33, 50])
        cuts = [*range(0, max(len(text) - vocab.longest, 1), size), len(text)]
        parts = [(text[a : min(b + vocab.longest, len(text))], b - a) for a, b in zip(cuts, cuts[1:])]
        states = piece_codec.boundary_states(np.stack([piece_codec.transfer(encoder, t, n) for t, n in parts]))
        spans = [t[states[k] : n + states[k + 1]] for k, (t, n) in enumerate(parts)]
        assert "".join(spans) == text
        scanned, whole = np.frombuffer(b"".join(encoder.encode(spans)), "<u4"), np.frombuffer(encoder.encode([text])[0], "<u4")
        assert path_score(vocab, scanned) == path_score(vocab, whole)


def test_encoding_of_awkward_rows(spark):
    docs = awkward(spark)
    found = piece_codec.digest(piece_codec.encode(docs, ["doc_id", "ids"[:0] or "kind"], piece_codec.Params(chunk_chars=5000), check=True)).collect()
    assert len(found) == 15 and all(r.round_trip for r in found)
    assert {r.doc_id: r.n_chunks for r in found if r.n_chunks > 1}.keys() == {7, 8}
    assert {r.doc_id for r in found if r.n_tokens == 0} == {1, 2}
    whole = by_id(piece_codec.digest(piece_codec.encode(docs, ["doc_id"], piece_codec.Params(chunk_chars=1 << 20))))
    assert all(r.n_tokens == pytest.approx(whole[r.doc_id].n_tokens, abs=2) for r in found)
    assert piece_codec.encode(empty(spark), ["doc_id"]).collect() == []


# --- token files


def test_repair_expands_to_what_it_compressed():
    rng = np.random.default_rng(1)
    params = token_files.Params(least_count=2, pairs_a_round=8, rounds=5)
    for ids in (np.zeros(0), np.zeros(101), rng.integers(0, 3, 500), rng.integers(0, 50_000, 50), np.tile([1, 2, 3, 1, 2], 60)):
        rules, lengths, sequence = token_files.compress(ids.astype(np.uint32), params)
        shard = token_files.Shard(rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), sequence.astype("<u4").tobytes())
        assert (shard.read(0, len(ids)) == ids).all()
        for low in range(0, len(ids), 7):
            assert (shard.read(low, min(low + 11, len(ids))) == ids[low : low + 11]).all()
    assert len(sequence) < 60


def test_units_give_the_ids_of_the_whole_text(spark, small):
    encoder = token_files.Encoder(token_files.Params())
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(50).collect()]
    texts += ["a  b", "  x", "", " ", "\n", " a", "a ", "it's 'tis", "x<|endoftext|>y", "日本 語", "\0 a b", "a\u00a0 b", "tab\t b", "a\n b"]
    texts += ["end.\nThe, end's 'll x's!s", "é,é ü! ñ'", "a\u2028b \u3000c", "\x1c \x1d", "12a,3b"]
    for run in W.runs(pa.array(texts + texts[:5]), 20_000):
        ids, counts = encoder.encode(run)
        for text, n, end in zip((texts + texts[:5])[run.rows], counts, np.cumsum(counts)):
            assert ids[end - n : end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_files_read_back(spark, tmp_path):
    docs = awkward(spark)
    path = str(tmp_path / "files")
    token_files.write(docs, path, token_files.Params(shard_ids=2000))
    found = token_files.read_back(spark.read.parquet(path)).collect()
    tokenizer = token_files._tokenizer("byte_bpe_50k.json")
    start, expected = 0, []
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for r in rows:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    token_files.write(empty(spark), str(tmp_path / "none"))
    none = spark.read.schema(token_files.SHARDS).parquet(str(tmp_path / "none"))
    assert token_files.read_back(none).collect() == []
