"""The pipeline's stages against what each must do on its own input, and the entry."""
import os
import re
import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline as C
from conftest import ROOT, SF001
from tablerail.llm import common, quality, simhash


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.read(spark, SF001, "documents")
    out = [docs]
    for name, fn in C.STAGES:
        out.append(common.keep(fn(spark, out[-1], SF001), f"test-{name}"))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in C.STAGES] == ["quality_filter", "near_dedup", "redact_pii", "mix_sources", "pack_windows"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_stage(spark, stages):
    model = quality.fit(stages[0], common.read(spark, SF001, "labels"))
    want = {r.doc_id for r in quality.classify(stages[0], model).collect() if r.predicted}
    assert {r.doc_id for r in stages[1].collect()} == want and 0 < len(want) <= stages[0].count()


def test_dedup_stage(stages):
    comp = {r.doc_id: r.component_id for r in simhash.near_duplicates(stages[1]).collect()}
    assert Counter(comp[r.doc_id] for r in stages[2].collect()) == Counter(set(comp.values()))


def test_pii_stage(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert before.keys() == after.keys()
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert not any(email.search(r.text or "") for r in after.values())
    assert any(email.search(r.text or "") for r in before.values())
    for k, r in after.items():
        assert r.text == before[k].text or "[" in r.text and r.n_chars == len(r.text)


def test_mix_stage(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[3:5])
    assert after.items() <= before.items() and 0.4 < len(after) / len(before) <= 1


def test_packing_stage(stages):
    pieces = stages[5].collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in stages[4].collect()}
    for doc in {p.doc_id for p in pieces}:
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert sum(p.length for p in own) == own[0].doc_tokens and own[0].start == 0


def test_empty_documents(spark):
    none = common.read(spark, SF001, "documents").limit(0)
    for name, fn in C.STAGES:
        none = common.keep(fn(spark, none, SF001), f"test-empty-{name}")
        assert none.count() == 0


def test_entry_works_without_the_optional_part(tmp_path):
    """A copy of the repository without the folder, the pipeline and these tests."""
    import shutil
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'agg1_progress' in q and not [k for k in q if k.startswith('op') or k == 'pipeline']; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env={**os.environ, "PYTHONPATH": ""})


def test_every_operator_is_registered():
    import __spark_entry__ as e
    names = e.queries()
    assert [k.split("_")[0] for k in names if re.match(r"op\d+_", k)] == [f"op{n}" for n in range(1, 14)] and "pipeline" in names
    assert {k for k in e.oracle_sql() if k.startswith("op")} == {"op6_mixing", "op7_warc", "op8_kdtree", "op11_secrets", "op12_codebooks", "op13_variants"}


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the operators' own, ids that repeat, and ties."""
    from tablerail.llm import pii, simhash
    names = ["__base", "__all", "__added", "__first", "__id", "id", "row", "first", "again", "least", "n", "changed", "a.b"]
    rows = [(1, "mail bob@example.com now", *names), (1, "mail bob@example.com now", *names), (2, "another text altogether, quite long", *names),
            (None, None, *names), (3, "", *names)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    out = pii.redact(df, pii.train(df))
    assert out.columns == df.columns
    got = sorted(out.collect(), key=str)
    assert all([r[c] for c in names] == names for r in got) and [r.text for r in got if r.doc_id == 1] == ["mail [EMAIL] now"] * 2
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "None"]
    assert all([r[c] for c in names] == names for r in kept.collect())
