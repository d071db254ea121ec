"""Quality and toxicity: held-out accuracy and defined results."""
import zlib

import pytest
from pyspark.sql import functions as F

from tablerail.llm import quality, toxicity

SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet")


def held(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


@pytest.fixture(scope="module")
def model(tables):
    return quality.fit(*tables)


def test_quality_held_out(tables, model):
    docs, labels = tables
    out = quality.classify(docs, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 4, 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    good, bad = [r for r in test if r.quality == 1], [r for r in test if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) >= 0.98
    assert sum(1 - r.predicted for r in bad) / len(bad) >= 0.9


def test_quality_scores_do_not_depend_on_batches(model):
    texts = ["Some words here.", None, "", "   ", "x", "many " * 50000, "Ünïcode 日本 text", "a a a a a a"]
    whole = model.scores(texts)
    assert [float(model.scores([t])[0]) for t in texts] == pytest.approx(whole.tolist(), abs=1e-9)
    assert whole[1] == whole[2] == whole[3]


def test_quality_edge_rows(spark, model):
    schema = "doc_id long, text string, score string, held_out int"
    rows = [(1, None, "a", 1), (None, "text", "b", 2), (2, "same", "c", 3), (2, "same", "c", 3)]
    df = spark.createDataFrame(rows, schema)
    out = quality.classify(df, model).collect()
    assert len(out) == 4 and [r.held_out for r in out if r.doc_id is None] == [False]
    kept = quality.keep_good(df, model, threshold=0.0)
    assert kept.columns == ["doc_id", "text", "score", "held_out"] and sorted(r.score for r in kept.collect()) == ["a", "b", "c", "c"]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = quality.fit(df, labels)
    assert set(quality.classify(df, none).toPandas().score) == {0.5}
    assert quality.classify(df.limit(0), none).count() == 0


@pytest.fixture(scope="module")
def lexicon(tables):
    return toxicity.fit(*tables)


def test_toxicity_held_out(tables, lexicon):
    docs, labels = tables
    out = toxicity.classify(docs, lexicon)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    toxic, clean = [r for r in test if r.toxic == 1], [r for r in test if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.9
    assert sum(r.predicted for r in clean) / len(clean) <= 0.01


def test_toxicity_score_is_the_curve(spark, tables, lexicon):
    import numpy as np
    texts = [t.text for t in tables[0].limit(300).collect()]
    auto = lexicon.automaton()
    got = [lexicon.features(auto, t) for t in texts]
    want = toxicity.curve_score(lexicon.curve, np.array([g[0] for g in got]), np.array([g[1] for g in got]))
    out = toxicity.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), lexicon).orderBy("doc_id").toPandas()
    assert out.score.tolist() == pytest.approx(want.tolist(), abs=1e-9)


def test_folding_and_exceptions():
    lex = toxicity.Lexicon({toxicity.fold("idiot"): 5.0, toxicity.fold("trash"): 4.0}, (" ".join(toxicity.words_of("trash can")),))
    auto = lex.automaton()
    for text in ("an idiot", "an 1D10T!", "an іdіоt", "ｉｄｉｏｔ", "id​iot", "IDIOTS"):
        assert lex.features(auto, text)[0] == 5.0, text
    assert lex.features(auto, "the trash can")[0] == 0.0
    assert lex.features(auto, "the trash can and trash")[0] == 4.0
    assert lex.features(auto, "patidiot")[0] == 0.0
    assert lex.features(auto, None) == (0.0, 0) and lex.features(auto, " ") == (0.0, 0)


def test_toxicity_edge_rows(spark, lexicon):
    schema = "doc_id long, text string, total string, words int"
    df = spark.createDataFrame([(1, None, "a", 1), (None, "idiot idiot", "b", 2), (2, "", "c", 3), (2, "", "c", 3)], schema)
    out = toxicity.classify(df, lexicon).collect()
    assert len(out) == 4 and {r.score for r in out if r.doc_id is not None} == {0.0}
    none = toxicity.fit(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.entries == {} and {r.score for r in toxicity.classify(df, none).collect()} == {0.0}
    assert toxicity.classify(df.limit(0), lexicon).count() == 0


def test_whole_texts_are_read(lexicon):
    auto = lexicon.automaton()
    assert lexicon.features(auto, "plain " * 200000 + "idiot")[0] > 0


def plain_features(text):
    """The classifier's features of one text, one by one with Python's integers."""
    mask, blank = 2**32 - 1, lambda c: c <= 32 or c in (0xA0, 0x3000)
    codes = [32] + [32 if blank(ord(c)) else ord(c) for c in text] + [32]
    power = [pow(0x9E3779B1, j + 1, 2**32) for j in range(64)]

    def bucket(h, salt):
        h = (h + salt * 0x27D4EB2F) * 0x85EBCA6B & mask
        h ^= h >> 15
        return (h * 0xC2B2AE35 & mask) >> (32 - quality.BITS)
    out = [bucket(sum(c * p for c, p in zip(codes[i:i + n], power, strict=False)) & mask, n)
           for n in (3, 4, 5) for i in range(len(codes) - n + 1) if all(c != 32 for c in codes[i + 1:i + n - 1])]
    last = None
    for word in "".join(map(chr, codes)).split(" "):
        if word:
            h = sum(ord(c) * power[j % 64] for j, c in enumerate(word)) & mask
            out += [bucket(h, 1)] + [quality.REPEAT] * (len(word) if h == last else 0)
            last = h
    return out


def test_quality_equals_plain_loops(tables, model):
    """Features averaged per document and scored one text at a time."""
    import math
    texts = [r.text for r in tables[0].orderBy("doc_id").limit(60).collect()] + ["", None, " \u3000 ", "a", "aa aa aa", "x" * 200, "日本 語 語\xa0語"]
    for t, got in zip(texts, model.scores(texts), strict=True):
        found = plain_features(t or "")
        z = model.bias + sum(float(model.logit[f]) for f in found) / (len(found) + quality.NEUTRAL)
        assert got == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6), (t or "")[:80]


def test_matches_equal_a_plain_scan():
    """Aho-Corasick against looking for every entry at every place."""
    import random
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abox1") for _ in range(rng.randint(1, 4)))
    for _ in range(400):
        entries = {toxicity.fold(word()) + rng.choice(["", " "]): float(rng.randint(1, 9)) for _ in range(rng.randint(0, 6))}
        exceptions = tuple({" ".join(toxicity.words_of(f"{word()} {word()}")) for _ in range(rng.randint(0, 2))})
        lex = toxicity.Lexicon(entries, exceptions)
        text = " ".join(word() for _ in range(rng.randint(0, 25)))
        words = toxicity.words_of(text)
        joined = f" {' '.join(words)} " if words else ""
        best = {}
        for i in range(len(joined)):
            here = [w for e, w in entries.items() if joined.startswith(f" {e}", i)]
            if here:
                best[i] = max(here)
        for x in exceptions:
            for a in range(len(joined)):
                if joined.startswith(f" {x} ", a):
                    best = {k: w for k, w in best.items() if not a <= k < a + len(x) + 1}
        assert lex.features(lex.automaton(), text) == (sum(best.values()), len(words)), (entries, exceptions, text)


@pytest.mark.parametrize("toxic", [500, 6000])
def test_kept_terms_do_not_depend_on_the_sample(spark, toxic):
    """A term in 100 toxic texts, always beside a commoner one, and a word of two letters."""
    base = "plain words stand here and there in every text of this small table"
    rows = [(i, f"{base} grolk{' vexnar' if i < 100 else ''}{' qz' if i % 5 == 0 else ''} n{i}", 1) for i in range(toxic)]
    rows += [(toxic + i, f"{base} fine n{i}", 0) for i in range(toxic)]
    lex = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4))
    auto = lex.automaton()
    assert all(lex.features(auto, f"a clean start then {w} ends")[0] > 0 for w in ("grolk", "vexnar", "qz"))
    assert lex.features(auto, base)[0] == 0 and lex.features(auto, "qzar")[0] == 0
