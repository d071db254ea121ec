"""Rules that keep operators bounded: tree combine, digests, few keys first."""
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators import udf
from tablerail.operators.upsert import one_row_per_key, upsert
from tablerail.session import TEST_NOW
from tablerail.sources.pages import TableFetcher

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def history(spark, hot=1000):
    rows = [("hot", i, "ABC"[i * i % 3]) for i in range(-7, hot)] + [("u", 5, "A"), ("v", None, "B"), ("v", 3, "C")]
    return spark.createDataFrame(rows, "url string, iteration int, stage string")


@pytest.mark.parametrize("chunk,fan_in", [(1, 2), (10, 3), (100, 64), (5000, 2)])
def test_a_tree_of_combines_equals_the_whole(spark, chunk, fan_in):
    got = {r.url: r for r in udf.rehydrate_by_url(history(spark), udf.stage_summary, udf.SUMMARY_SCHEMA, chunk, udf.joined_summary, fan_in).collect()}
    stages = ["ABC"[i * i % 3] for i in range(-7, 1000)]
    r = got["hot"]
    assert (r.n_rows, r.changes, r.first_stage, r.last_stage) == (
        len(stages), sum(a != b for a, b in zip(stages, stages[1:], strict=False)), stages[0], stages[-1])
    assert (got["u"].n_rows, got["v"].n_rows, len(got)) == (1, 2, 3)


def test_groups_hold_at_most_fan_in_objects(spark):
    def checked(pdf):
        if len(pdf) > 4:
            raise ValueError("too many objects in one call")
        return udf.joined_summary(pdf)
    got = udf.rehydrate_by_url(history(spark), udf.stage_summary, udf.SUMMARY_SCHEMA, 20, checked, 4)
    assert got.count() == 3


def test_a_combine_must_return_one_object(spark):
    def keeps_all(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.drop(columns="_to")
    with pytest.raises(Exception, match="must return one row"):
        udf.rehydrate_by_url(history(spark), udf.stage_summary, udf.SUMMARY_SCHEMA, 20, keeps_all, 4).collect()


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_many_slices_share_a_call(spark, batch):
    """A function for many slices is called once a batch, not once a slice, and gives what
    slice by slice calls give, wherever the batches end."""
    calls = spark.sparkContext.accumulator(0)

    @udf.many_slices
    def counted(pdf):
        calls.add(1)
        return udf.stage_summary(pdf)
    rows = spark.createDataFrame([(f"u{i % 40}" if i % 41 else None, i // 40, "ABC"[i * i % 3]) for i in range(4000)], "url string, iteration int, stage string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = udf.rehydrate_by_url(rows, counted, udf.SUMMARY_SCHEMA, 10).collect()
        plain = udf.rehydrate_by_url(rows, lambda pdf: udf.stage_summary(pdf), udf.SUMMARY_SCHEMA, 10).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(str, got)) == sorted(map(str, plain)) and len({(r.url, r.part) for r in got}) == len(got)
    assert sum(r.n_rows for r in got) == 4000 and (batch == "3" or calls.value < len(got) / 10)


def test_rows_pass_the_exchange_once(spark):
    b = spark.createDataFrame([("k", "x" * 10, None), ("k", "x" * 10, None), ("j", None, "y")], "url string, source string, tags string")
    df = one_row_per_key(b, ["url"])
    assert sorted(df.collect()) == [("j", None, "y"), ("k", "x" * 10, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_first" in line)
    # one copy of the row and four longs in the partial result
    assert partial.count("partial_first(") == 1 and "partial_min(_row" not in plan and "partial_max(_row" not in plan


@pytest.mark.parametrize("a,b", [(("x", None), (None, "x")), (("ab", "c"), ("a", "bc")), (("1", None), ("1", "")), ((None, None), ("", None))])
def test_digests_tell_rows_apart(spark, a, b):
    rows = spark.createDataFrame([("k", *a), ("k", *b)], "url string, source string, tags string")
    with pytest.raises(Exception, match="duplicate primary keys"):
        one_row_per_key(rows, ["url"]).collect()


def test_upsert_still_raises_on_conflicts(spark):
    old = spark.createDataFrame([], S.URL.schema)
    rows = spark.createDataFrame([("u", "a"), ("u", "b")], "url string, source string")
    with pytest.raises(Exception, match="duplicate primary keys"):
        upsert(old, rows, S.URL, TEST_NOW).collect()
    same = spark.createDataFrame([("u", "a"), ("u", "a")], "url string, source string")
    assert upsert(old, same, S.URL, TEST_NOW).count() == 1


def test_few_keys_are_joined_with_the_crawl_before_it_is_grouped(spark, monkeypatch):
    crawl = spark.range(300).select(F.concat(F.lit("u"), F.col("id") % 100).alias("url"), F.concat(F.lit("<p>"), "id").alias("html"), "id")
    keys = spark.createDataFrame([("u3", 0), ("u3", 1), ("none", 0)], "url string, iteration int")
    out = {}
    for limit in (100, 1):
        monkeypatch.setattr(TableFetcher, "FEW_KEYS", limit)
        f = TableFetcher(crawl, version_col="id")
        plan = f.pages_of(keys)._jdf.queryExecution().optimizedPlan().toString()
        # the join with the keys lies under the grouping, or is not there
        assert ("LeftSemi" in plan) == (limit == 100)
        if limit == 100:
            assert plan.index("Aggregate") < plan.index("LeftSemi")
        out[limit] = sorted((r.url, r.iteration, r.html) for r in f.fetch(keys).collect() if r.html)
    assert out[100] == out[1] == [("u3", 0, "<p>203"), ("u3", 1, "<p>203")]


def test_bounded_insert_does_not_exchange_the_table(spark):
    from tablerail.operators.upsert import insert_only_new_bounded
    table = spark.range(500).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("s").alias("source"))
    batch = spark.createDataFrame([("u1", "a"), ("new", "b"), (None, "c")], "url string, source string")
    out = {few: insert_only_new_bounded(table, batch, ["url"], few) for few in (10, 1)}
    assert sorted(map(str, out[10].collect())) == sorted(map(str, out[1].collect())) and out[10].count() == 2
    assert "ResolvedHint (strategy=broadcast)" in out[10]._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in out[1]._jdf.queryExecution().analyzed().toString()
