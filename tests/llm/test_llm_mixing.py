"""Mixing: marginals after raking, calibrated probabilities, the SQL."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tablerail.llm import mixing as M
from tablerail.testing import duckdb_for

KEYS = ["m_source", "m_lang", "m_topic"]


def cells(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    return docs, docs.select(*M._keyed(docs, M.topic_of(F.col("text"))), M.tokens_of(F.col("text")).alias("tokens")).groupBy(*KEYS).agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))


def test_raked_marginals_meet_the_targets(spark):
    _, c = cells(spark)
    targets = {k: M.tempered(c, k, 0.5) for k in KEYS}
    raked = M.rake(c, targets, rounds=12).toPandas()
    for k in KEYS:
        want = targets[k].toPandas().set_index(k).target
        want = want / want.sum()
        got = raked.groupby(k).w.sum() / raked.w.sum()
        assert (got - want).abs().max() < 1e-3


def test_margins_and_scale_of_skewed_sparse_cells(spark):
    """With the registered parameters, where six rounds leave errors of over a hundredth."""
    rng = np.random.default_rng(3)
    t = np.exp(rng.normal(size=(12, 5, 3)) * 2 + 6)
    t[0] *= t[1:].sum() / t[0].sum() / 2
    t = np.where(rng.random(t.shape) < 0.5, 0, t).astype(int)
    c = spark.createDataFrame([(f"s{a}", f"l{b}", f"t{d}", int(t[a, b, d]), 1) for a, b, d in np.ndindex(t.shape) if t[a, b, d]],
                              "m_source string, m_lang string, m_topic string, tokens long, docs long")
    targets = {k: M.tempered(c, k, 0.8) for k in KEYS}
    kept = M.rake(c, targets)
    raked = kept.toPandas()
    for k in KEYS:
        want = targets[k].toPandas().set_index(k).target
        want = want / want.sum()
        got = raked.groupby(k).w.sum() / raked.w.sum()
        assert ((got - want) / want).abs().max() <= M.TOLERANCE
    p = M.probabilities(kept, 0.7).toPandas()
    assert (p.probability * p.tokens).sum() / p.tokens.sum() == pytest.approx(0.7, abs=1e-9)


def test_targets_that_cannot_be_met_are_reported(spark):
    c = spark.createDataFrame([("a", "en", "x", 10, 1), ("b", "fr", "x", 90, 1)], "m_source string, m_lang string, m_topic string, tokens long, docs long")
    targets = {k: spark.createDataFrame(rows, f"{k} string, target double") for k, rows in (
        ("m_source", [("a", 0.5), ("b", 0.5)]), ("m_lang", [("en", 0.1), ("fr", 0.9)]))}
    with pytest.warns(UserWarning, match="cannot all be met"):
        M.rake(c, targets)


def test_probabilities_are_calibrated(spark):
    _, c = cells(spark)
    raked = M.rake(c, {k: M.tempered(c, k, 0.5) for k in KEYS})
    p = M.probabilities(raked, 0.6).toPandas()
    assert p.probability.between(0, 1).all()
    assert (p.probability * p.tokens).sum() / p.tokens.sum() == pytest.approx(0.6, abs=1e-6)
    low = p[p.probability < 1]
    assert (low.probability / (low.w / low.tokens)).std() < 1e-9


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_sample_matches_the_sql(spark, sf):
    """Also where six rounds do not meet the margins (the smaller input takes ten)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = M.sample(docs, 0.7, 0.8, "mix", with_details=True).select(
        "doc_id", F.col("m_source").alias("source"), F.col("m_lang").alias("lang"), F.col("m_topic").alias("topic"), "tokens",
        F.round("probability", 6).alias("probability"))
    want = duckdb_for(sf).sql(M.oracle_sql(0.7, 0.8, "mix")).df()
    got = out.toPandas()
    cols = ["doc_id", "source", "lang", "topic", "tokens", "probability"]
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, want[cols].values.tolist()))
    assert 0.5 < len(got) / docs.count() < 0.9


def test_large_cell_tables_take_the_salted_join(spark, monkeypatch):
    docs, _ = cells(spark)
    want = {r.doc_id for r in M.sample(docs).select("doc_id").collect()}
    monkeypatch.setattr(M, "BROADCAST_CELLS", 0)
    assert {r.doc_id for r in M.sample(docs).select("doc_id").collect()} == want


def test_edge_rows(spark):
    schema = "doc_id long, text string, source string, lang string, w double, probability string"
    rows = [(i, "some words 1" if i % 2 else "some words", "a" if i % 3 else None, None if i % 5 else "en", 1.0, "x") for i in range(200)]
    rows += [(None, "words", "b", "fr", None, None), (None, "words", "b", "fr", None, None), (300, None, None, None, 2.0, "y"), (301, "", "empty", "zz", 2.0, "y")]
    df = spark.createDataFrame(rows, schema)
    out = M.sample(df, 0.5)
    assert out.columns == df.columns and 0 < out.count() <= len(rows)
    assert out.where("doc_id = 301").count() == 1  # a cell without tokens is kept whole
    assert out.where("doc_id is null").count() in (0, 2)
    assert M.sample(df.limit(0)).count() == 0
    assert M.sample(df, 1.0, 1.0).count() == len(rows)


def test_main_path_runs_no_python(spark):
    docs, _ = cells(spark)
    plan = M.sample(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
