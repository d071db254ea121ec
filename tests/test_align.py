"""Alignment, stamping and metadata (PRJ1, PRJ2, PRJ4, PRJ5, PRJ7)."""
import math

import pytest
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators import align as A
from tablerail.session import TEST_NOW


def test_align_nested_nan_and_dupes(spark):
    df = spark.createDataFrame([("u", 1.5, ["a", "é"]), ("u", float("nan"), ["a", "é"]), ("u", 1.5, ["a", "é"])],
                               "url string, score double, tags array<string>")
    out = A.align(df, ["url", "tags", "score", "missing"]).orderBy("score").collect()
    assert [tuple(r) for r in out] == [("u", '["a","é"]', None, None), ("u", '["a","é"]', 1.5, None)]


def test_align_strict_raises_on_missing(spark):
    df = spark.createDataFrame([("u",)], "url string")
    with pytest.raises(ValueError):
        A.align_strict(df, S.URL)
    # extras are dropped even when strict
    full = spark.createDataFrame([("u", None, None, None, None, 1)], S.URL.schema.simpleString()[:-1] + ",x:int>")
    assert A.align_strict(full, S.URL).columns == S.URL.columns


def test_stamp_fills_only_nulls(spark):
    df = spark.createDataFrame([("u", None), ("v", None)], "url string, created_at timestamp_ntz")
    df = df.withColumn("created_at", F.when(F.col("url") == "v", F.expr("timestamp_ntz'2020-01-01 00:00:00'")))
    out = {r.url: r for r in A.stamp(df, S.URL, TEST_NOW).collect()}
    assert str(out["u"].created_at) == "2024-01-15 00:00:00" and str(out["v"].created_at) == "2020-01-01 00:00:00"
    assert str(out["u"].updated_at) == "2024-01-15 00:00:00"


def test_stamp_llm_defaults(spark):
    df = spark.createDataFrame([("u", None, None)], "url string, llm_provider string, model_id string")
    out = A.stamp(df, S.WEB_SUMMARY, TEST_NOW, policy={"llm_provider": "default", "model_id": "param"},
                  params={"model_id": "m1"}).collect()[0]
    assert (out.llm_provider, out.model_id) == ("openai", "m1")


def test_iteration_modes(spark):
    df = spark.createDataFrame([("u", None), ("v", 3)], "url string, iteration int")
    assert {r.url: r.iteration for r in A.stamp_iteration(df, "constant", 9).collect()} == {"u": 9, "v": 3}
    assert A.stamp_iteration(df, "none").collect() == df.collect()
    with pytest.raises(ValueError):
        A.stamp_iteration(df, "param")
    with pytest.raises(ValueError):
        A.stamp_iteration(df, "pipeline_control")
    with pytest.raises(ValueError):
        A.stamp_iteration(df, "sometimes", 1)


def test_add_metadata_never_overwrites(spark):
    df = spark.createDataFrame([("u", "mine")], "url string, source_file string")
    out = A.add_metadata(df, S.PIPELINE_CONTROL, source_file="x.json", iteration=4).collect()[0]
    assert (out.source_file, out.iteration) == ("mine", 4)
    assert "llm_provider" not in A.add_metadata(df, S.PIPELINE_CONTROL, llm_provider="openai").columns
