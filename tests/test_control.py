"""Control-plane algebra and run counters (FIXTURES.md §6)."""
from pyspark.sql import functions as F

from conftest import SF001
from tablerail import schemas as S
from tablerail.operators import control as C
from tablerail.operators.upsert import upsert
from tablerail.plans.fixtures import control_base, incoming_fx
from tablerail.plans.runs import run_url_stage
from tablerail.session import TEST_NOW, TEST_WORKER

PK = ["url", "iteration"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _pk_unique(df):
    return df.groupBy(*PK).count().where("count > 1").count() == 0


def test_upsert_twice_equals_once(spark):
    c, inc = control_base(spark, SF001), incoming_fx(spark, SF001)
    once = upsert(c, inc, S.PIPELINE_CONTROL, TEST_NOW)
    twice = upsert(once, inc, S.PIPELINE_CONTROL, TEST_NOW)
    assert _rows(once) == _rows(twice)
    assert _pk_unique(once)


def test_upsert_plans_agree(spark):
    c, inc = control_base(spark, SF001), incoming_fx(spark, SF001)
    a = upsert(c, inc, S.PIPELINE_CONTROL, TEST_NOW)
    b = upsert(c, inc.unionByName(inc), S.PIPELINE_CONTROL, TEST_NOW)
    assert _rows(a) == _rows(b)


def test_upsert_rejects_duplicate_keys(spark):
    c, inc = control_base(spark, SF001), incoming_fx(spark, SF001)
    dup = inc.unionByName(inc.limit(1).withColumn("notes", F.lit("other")))
    import pytest
    # raised by the same plan that writes, not by a separate job
    with pytest.raises(Exception, match="duplicate primary keys"):
        upsert(c, dup, S.PIPELINE_CONTROL, TEST_NOW).collect()


def test_upsert_refuses_null_and_uncastable_keys(spark):
    import pytest
    old = spark.createDataFrame([], S.WEB_PAGE.schema)
    for rows in ([("u", "abc")], [("u", None)], [(None, "1")]):
        bad = spark.createDataFrame(rows, "url string, iteration string")
        with pytest.raises(Exception, match="NULL in primary key"):
            upsert(old, bad, S.WEB_PAGE, TEST_NOW).collect()
    # a batch without the column gets the default
    assert [r.iteration for r in upsert(old, spark.createDataFrame([("u",)], "url string"), S.WEB_PAGE, TEST_NOW).collect()] == [0]


def test_conflicting_payloads_of_one_key_raise(spark):
    import pytest
    c = control_base(spark, SF001)
    keys = c.select("url", "iteration").limit(1)
    both = keys.withColumn("final_status", F.lit("ERROR")).unionByName(keys.withColumn("final_status", F.lit("COMPLETED")))
    with pytest.raises(Exception, match="conflicting values for key"):
        C.release(c, both, "w-1", TEST_NOW).control.collect()
    assert C.release(c, both.where("final_status = 'ERROR'").unionAll(both.where("final_status = 'ERROR'")), "w-1", TEST_NOW).control.count() == c.count()


def test_sync_replace_keeps_rows_without_iteration(spark):
    cols = S.PIPELINE_CONTROL.schema
    c = spark.createDataFrame([("u", None) + (None,) * 10, ("u", 0) + (None,) * 10], cols)
    urls = spark.createDataFrame([("v",)], "url string")
    got = sorted((r.url, r.iteration) for r in C.sync_from_registry(urls, c, TEST_NOW, mode="replace").collect() if r.iteration is not None)
    assert got == [("v", 0)] and C.sync_from_registry(urls, c, TEST_NOW, mode="replace").where("iteration IS NULL").count() == 1



def test_unknown_policy_raises(spark):
    c = control_base(spark, SF001)
    try:
        upsert(c, c, S.PIPELINE_CONTROL, TEST_NOW, policy="merge-ish")
    except ValueError:
        pass
    else:
        raise AssertionError


def test_claim_then_claim_is_nothing(spark):
    c = control_base(spark, SF001)
    keys = C.worklist(c, "WEB_PAGE", ["NEW"], TEST_NOW, max_rows=None)
    first = C.claim(c, keys, TEST_WORKER, TEST_NOW)
    assert first.rows.count() == keys.count() > 0
    second = C.claim(first.control, keys, "w-other", TEST_NOW)
    assert second.rows.count() == 0
    assert _rows(second.control) == _rows(first.control)


def test_release_by_non_holder_changes_nothing(spark):
    c = control_base(spark, SF001)
    keys = c.select(*PK)
    r = C.release(c, keys, "nobody", TEST_NOW, final_status="COMPLETED")
    assert r.rows.count() == 0
    assert _rows(r.control) == _rows(c)


def test_step_on_final_sticky_gate_is_noop(spark):
    c = control_base(spark, SF001).where((F.col("stage") == "DONE") & F.col("task_state").isin("SKIP", "HOLD"))
    assert _rows(C.step(c, TEST_NOW)) == _rows(c)


def test_operators_keep_pk_unique(spark):
    c = control_base(spark, SF001)
    for out in (C.advance_completed(c, TEST_NOW).control, C.retry_errors(c, TEST_NOW).control,
                C.advance_all_completed(c, TEST_NOW).control, run_url_stage(c, TEST_NOW, "w").control):
        assert out.count() == c.count()
        assert _pk_unique(out)


def _url_control(spark, n):
    """n URL/NEW/READY rows."""
    rows = [(f"https://x.example/{i}", 0, "URL", "NEW", "READY", False, None, None, None, None,
             None, None) for i in range(n)]
    df = spark.createDataFrame(rows, S.PIPELINE_CONTROL.schema)
    return df.withColumn("created_at", F.expr("timestamp_ntz'2024-01-01 00:00:00'") +
                         F.make_dt_interval(F.lit(0), F.lit(0), F.substring_index("url", "/", -1).cast("int")))


def _counters(run):
    r = run.counters().collect()[0]
    return (r.found, r.claimed, r.completed, r.enqueued_next)


def test_counters_all_free(spark):
    assert _counters(run_url_stage(_url_control(spark, 8), TEST_NOW, "w", max_batch=5)) == (5, 5, 5, 5)


def test_counters_nothing_ready(spark):
    c = _url_control(spark, 4).withColumn("task_state", F.lit("HOLD"))
    assert _counters(run_url_stage(c, TEST_NOW, "w")) == (0, 0, 0, 0)


def test_counters_lost_races(spark):
    c = _url_control(spark, 12)
    listed = C.worklist(c, "URL", ["NEW"], TEST_NOW, max_rows=10)
    lost = listed.limit(3)
    raced = C.claim(c, lost, "w-other", TEST_NOW, lease_minutes=60).control
    assert _counters(run_url_stage(c, TEST_NOW, "w", max_batch=10, claim_view=raced)) == (10, 7, 7, 7)


def test_counters_drift(spark):
    c = _url_control(spark, 3)
    drifted = c.withColumn("stage", F.when(F.col("url").endswith("/1"), "WEB_PAGE").otherwise(F.col("stage")))
    run = run_url_stage(c, TEST_NOW, "w", claim_view=drifted)
    assert _counters(run) == (3, 3, 2, 2)
    bad = run.control.where(F.col("url").endswith("/1")).collect()[0]
    assert (bad.stage, bad.status, bad.is_claimed, bad.worker_id) == ("WEB_PAGE", "ERROR", False, None)


def test_sync_is_idempotent(spark):
    from tablerail.plans.fixtures import url_fx
    u = url_fx(spark, SF001)
    once = C.sync_from_registry(u, spark.createDataFrame([], S.PIPELINE_CONTROL.schema), TEST_NOW)
    twice = C.sync_from_registry(u, once, TEST_NOW)
    assert _rows(once) == _rows(twice)
