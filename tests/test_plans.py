"""Physical-plan properties the operators rely on at scale."""
from pyspark.sql import functions as F

from conftest import SF001
from tablerail import schemas as S
from tablerail.operators import control as C
from tablerail.operators import queries as Q
from tablerail.operators.upsert import upsert
from tablerail.plans.fixtures import control_base, incoming_fx, read_table
from tablerail.session import TEST_NOW, TEST_WORKER


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_state_uses_partial_group_limit(spark):
    p = plan(Q.latest_state(control_base(spark, SF001)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_worklist_is_top_k(spark):
    p = plan(C.worklist(control_base(spark, SF001), "WEB_PAGE", ["NEW"], TEST_NOW, max_rows=20))
    assert "TakeOrderedAndProject" in p


def exchanges(df):
    import re
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", plan(df))


def test_upsert_exchanges_each_side_once_on_the_key(spark):
    cols = S.PIPELINE_CONTROL.schema
    old = spark.range(100).select(*[F.col("id").cast("string").cast(f.dataType).alias(f.name) if f.name in ("url", "iteration")
                                    else F.lit(None).cast(f.dataType).alias(f.name) for f in cols.fields])
    found = exchanges(upsert(old, old, S.PIPELINE_CONTROL, TEST_NOW))
    assert len(found) == 2 and all(k == "hashpartitioning" and "url" in a and "iteration" in a for k, a in found)


def test_unlimited_url_stage_is_one_narrow_pass(spark):
    from tablerail.plans.runs import run_url_stage
    c = spark.createDataFrame([], S.PIPELINE_CONTROL.schema)
    run = run_url_stage(c, TEST_NOW, TEST_WORKER)
    assert "Exchange" not in plan(run.control) and "Join" not in plan(run.control)
    assert "Join" not in plan(run.outcomes)
    assert "Join" in plan(run_url_stage(c, TEST_NOW, TEST_WORKER, max_batch=5).control)


def test_nothing_is_broadcast_by_hint(spark):
    from tablerail.operators.predicates import include_urls
    c = spark.createDataFrame([], S.PIPELINE_CONTROL.schema)
    wl = C.worklist(c, "WEB_PAGE", ["NEW"], TEST_NOW, max_rows=20)
    listed = include_urls(wl, spark.range(5_000_000).select(F.col("id").cast("string").alias("url")))
    logical = listed._jdf.queryExecution().logical().toString() + C.claim(c, listed, TEST_WORKER, TEST_NOW).control._jdf.queryExecution().logical().toString()
    assert "UnresolvedHint" not in logical and "broadcast" not in logical.lower()


def test_loader_sorts_only_on_request(spark):
    c = control_base(spark, SF001)
    assert "rangepartitioning" not in plan(Q.load_table(c, S.PIPELINE_CONTROL, stage="DONE"))
    rows = Q.load_table(c, S.PIPELINE_CONTROL, order_by="created_at ASC, bogus DESC").collect()
    assert [r.created_at for r in rows] == sorted(r.created_at for r in rows)
    rows = Q.load_table(c, S.PIPELINE_CONTROL, order_by="default").collect()
    at = [r.updated_at for r in rows]
    assert [x for x in at if x] == sorted((x for x in at if x), reverse=True) and at[-1] is None


def test_hot_url_queries_limit_before_the_shuffle(spark):
    from tablerail.plans.q_reads import control_hot, signup_urls
    c = control_hot(spark, SF001)
    for df in (C.advance_all_completed(c, TEST_NOW).control, Q.control_rows_for_urls(c, signup_urls(spark, SF001), True)):
        assert "WindowGroupLimit" in plan(df) and "Partial" in plan(df)


def test_filters_and_columns_reach_the_scan(spark):
    d = read_table(spark, SF001, "events").where(F.col("event_type") == "signup").select("user_id")
    p = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in p
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in p


def test_text_cleaning_has_no_python(spark):
    from tablerail.functions.text import clean_page_text
    d = read_table(spark, SF001, "documents").select(clean_page_text("text"))
    assert "Python" not in plan(d) and "ArrowEval" not in plan(d)


def test_hot_url_is_sliced_and_limited(spark):
    from tablerail.plans.q_reads import HOT_URL, control_hot
    c = control_hot(spark, SF001)
    hot_rows = c.where(F.col("url") == HOT_URL).count()
    assert hot_rows > c.count() / 3
    parts = Q.group_by_url(c).where(F.col("url") == HOT_URL).collect()
    assert sum(r.n_rows for r in parts) == hot_rows and max(r.n_rows for r in parts) <= 1000
    assert all(r["items"][0].asDict().keys() == set(c.columns) for r in parts)
    p = plan(Q.latest_state(c))
    assert "WindowGroupLimit" in p
    assert Q.latest_state(c).where(F.col("url") == HOT_URL).count() == 1


def test_keyed_update_hashes_on_full_key(spark):
    from tablerail.plans.q_reads import control_hot
    import re
    p = plan(C.advance_completed(control_hot(spark, SF001), TEST_NOW).control)
    # the join shuffles on (url, iteration); only the per-URL top-1 partitions by url alone
    assert re.search(r"hashpartitioning\(url#\d+, iteration#\d+", p)


def test_group_ordinal_matches_row_number_on_a_hot_group(spark):
    import re
    from pyspark.sql import Window
    e = read_table(spark, SF001, "events")
    # one user holds every view and click (~40% of the rows); a few NULL users too
    e = e.withColumn("user_id", F.when(F.col("event_type").isin("view", "click"), F.lit(-1))
                     .when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(F.col("user_id")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    brute = e.select("event_id", (F.row_number().over(w) - 1).alias("it"))
    got = Q.group_ordinal(e, ["user_id"], ["ts", "event_id"], "it", pieces=16)
    mine = got.select("event_id", "it")
    assert mine.count() == e.count()
    assert brute.exceptAll(mine).count() == 0 and mine.exceptAll(brute).count() == 0
    # the ranking window is partitioned by (user, piece), never by the user alone
    p = plan(got)
    assert re.search(r"row_number\(\) windowspecdefinition\(user_id#\d+L, _piece#\d+", p)


def test_spread_only_when_the_scan_has_too_few_splits(spark):
    from tablerail.session import spread
    one = read_table(spark, SF001, "documents")  # one file, one row group
    assert one.rdd.getNumPartitions() == 1
    s = spread(one)
    assert s.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "RoundRobinPartitioning" in plan(s)
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert "Exchange" not in plan(spread(many))


def test_fetch_keys_hash_on_the_whole_key(spark):
    import re
    from tablerail.sources.pages import TableFetcher
    pages = read_table(spark, SF001, "pages")
    # one URL with many iterations: the keys must not all land on one partition
    hot = pages.select("url").first()[0]
    keys = spark.range(200).select(F.when(F.col("id") >= 0, F.lit(hot)).alias("url"),  # not a constant
                                   F.col("id").cast("int").alias("iteration"))
    got = TableFetcher(pages).fetch(keys)
    assert re.search(r"hashpartitioning\(url#\d+, iteration#\d+", plan(got))
    assert got.count() == 200 and got.where(F.col("html").isNull()).count() == 0


def test_empty_lists_match_nothing(spark):
    c = control_base(spark, SF001)
    assert C.worklist(c, "URL", [], TEST_NOW).count() == 0
    assert Q.load_table(c, S.PIPELINE_CONTROL, status=[]).count() == 0


def test_worklist_and_runner_have_no_default_cap(spark):
    from tablerail.plans.runs import run_url_stage
    rows = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(0).alias("iteration"), F.lit("URL").alias("stage"),
                                    F.lit("NEW").alias("status"), F.lit("READY").alias("task_state"), F.lit(False).alias("is_claimed"), *[
        F.lit(None).cast(S.PIPELINE_CONTROL.dtype(x)).alias(x) for x in S.PIPELINE_CONTROL.columns[6:]])
    assert C.worklist(rows, "URL", ["NEW"], TEST_NOW).count() == 3000
    assert run_url_stage(rows, TEST_NOW, TEST_WORKER).counters().first()["enqueued_next"] == 3000
