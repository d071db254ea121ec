"""Feistel sharding: the permutation, the law, and reproducibility."""
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tablerail.llm import sharding as S


@pytest.mark.parametrize("total", [0, 1, 2, 3, 7, 24, 25, 100, 1023, 4099])
def test_places_are_a_permutation(total):
    got = [S.place(i, total, 24) for i in range(total)]
    assert len(set(got)) == total
    by = defaultdict(list)
    for s, t in got:
        by[s].append(t)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert total < 24 or max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_columns_agree_with_the_direct_computation(spark):
    n = 500
    rows = spark.range(n).select("id", S.permuted(F.col("id"), n).alias("p")).collect()
    assert {(r.id, (r.p % 24, r.p // 24)) for r in rows} == {(i, S.place(i, n, 24)) for i in range(n)}


def check(rows, shards=24):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = S.shard_rows(docs).collect()
    text = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert len(out) == len(text)
    check(out)
    for r in out:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 8, zlib.crc32(text[r.doc_id]), "rows", None)
    again = S.shard_rows(docs.repartition(7, "lang")).collect()
    assert sorted(map(tuple, (r[:6] for r in again))) == sorted(map(tuple, (r[:6] for r in out)))
    full = {r.doc_id: (r.shard, r.slot) for r in S.shard_documents(docs).collect()}
    assert full == {r.doc_id: (r.shard, r.slot) for r in out}


def test_edge_rows(spark):
    schema = "doc_id long, text string, shard string, slot int, n int, h string"
    rows = [(None, None, "a", 1, 1, "x"), (1, "", "a", 1, 1, None), (2, None, None, None, None, "y")] + [(3, "é", "a", 1, 1, "z")] * 40
    df = spark.createDataFrame(rows, schema)
    out = S.shard_rows(df).collect()
    assert len(out) == len(rows)
    check(out)
    assert {r["size"] for r in out if r.doc_id == 3} == {10} and {r["size"] for r in out if r.doc_id == 2} == {8}
    whole = S.shard_documents(df)
    assert whole.columns == ["doc_id", "text", "n", "h", "shard", "slot"]
    check(whole.collect())
    assert S.shard_rows(df.limit(0)).count() == 0 and S.shard_documents(df.limit(0)).count() == 0


def test_main_path_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = S.shard_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
