"""Registered read queries over the control fixture (M1): filters, worklist,
aggregations, latest-per-key, ordering, loaders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators import control as C
from tablerail.operators import predicates as P
from tablerail.operators import queries as Q
from tablerail.operators.align import decision_state
from tablerail.plans.catalog import register
from tablerail.plans.fixtures import (control_base, control_fx, read_table, url_fx, web_page_fx,
                                      with_fixtures)
from tablerail.session import TEST_NOW, ts

NOW_SQL = f"TIMESTAMP '{TEST_NOW}'"
CONTROL_COLS = ", ".join(S.PIPELINE_CONTROL.columns)
FX_COLS = CONTROL_COLS + ", decision_flag, transition_flag"
FLT1_SQL = ("task_state = 'READY' AND (is_claimed = FALSE OR lease_until IS NULL OR lease_until < "
            + NOW_SQL + ")")


def signup_urls(spark, sf_dir):
    """Data-derived include list: URLs of users with a signup event."""
    e = read_table(spark, sf_dir, "events")
    return (e.where(F.col("event_type") == "signup")
            .select(F.concat(F.lit("https://u.example/"), F.col("user_id").cast("string")).alias("url")).distinct())


SIGNUP_URLS_SQL = "SELECT DISTINCT concat('https://u.example/', user_id) AS url FROM events WHERE event_type = 'signup'"


# ---------------------------------------------------------------- AGG1 / M0
@register("agg1_progress", with_fixtures(
    "SELECT stage, status, CAST(COUNT(*) AS BIGINT) AS count FROM control_fx GROUP BY stage, status "
    "ORDER BY stage, status", "control_fx"))
def agg1_progress(spark, sf_dir):
    """AGG1: rows per (stage, status)."""
    return Q.progress_counts(control_fx(spark, sf_dir))


# ---------------------------------------------------------------- WRK1, SRT1, FLT1
@register("wrk1_worklist", with_fixtures(
    f"SELECT url, iteration FROM control_fx WHERE stage = 'WEB_PAGE' AND status IN ('NEW') AND {FLT1_SQL}", "control_fx"))
def wrk1_worklist(spark, sf_dir):
    """WRK1: every claimable key at WEB_PAGE/NEW."""
    return C.worklist(control_fx(spark, sf_dir), "WEB_PAGE", ["NEW"], TEST_NOW)


@register("wrk1_worklist_top", with_fixtures(
    f"SELECT url, iteration FROM control_fx WHERE stage = 'WEB_PAGE' AND status IN ('NEW') AND {FLT1_SQL} "
    "ORDER BY created_at NULLS LAST, url, iteration LIMIT 100", "control_fx"))
def wrk1_worklist_top(spark, sf_dir):
    """WRK1 + SRT1 with an explicit limit: the 100 oldest claimable keys."""
    return C.worklist(control_fx(spark, sf_dir), "WEB_PAGE", ["NEW"], TEST_NOW, max_rows=100)


@register("wrk1_worklist_retry", with_fixtures(
    f"SELECT url, iteration FROM control_fx WHERE stage = 'URL' AND status IN ('NEW','ERROR','IN_PROGRESS') "
    f"AND {FLT1_SQL}", "control_fx"))
def wrk1_worklist_retry(spark, sf_dir):
    """WRK1 with retry statuses (NEW, ERROR, IN_PROGRESS with an expired lease), no limit."""
    return C.worklist(control_fx(spark, sf_dir), "URL", ["NEW", "ERROR", "IN_PROGRESS"], TEST_NOW, max_rows=None)


@register("flt1_claimable", with_fixtures(
    f"SELECT {CONTROL_COLS} FROM control_base WHERE stage = 'WEB_SUMMARY' AND status IN ('NEW','ERROR') "
    f"AND {FLT1_SQL}", "control_base"))
def flt1_claimable(spark, sf_dir):
    """FLT1: the claimable predicate on whole rows."""
    c = control_base(spark, sf_dir)
    return c.where(P.claimable("WEB_SUMMARY", ["NEW", "ERROR"], TEST_NOW))


@register("flt3_filters", with_fixtures(
    f"SELECT {CONTROL_COLS} FROM control_base WHERE stage = 'WEB_PAGE' AND status IN ('NEW','ERROR') "
    "ORDER BY updated_at DESC NULLS LAST", "control_base"))
def flt3_filters(spark, sf_dir):
    """FLT3 + SRC4: keyword filters (unknown key ignored, lower-case status upper-cased)."""
    return Q.load_table(control_base(spark, sf_dir), S.PIPELINE_CONTROL, stage="web_page",
                        status=["new", "ERROR"], version="v1", worker_id=None)


NULLGATE_SQL = with_fixtures(
    f"SELECT {CONTROL_COLS} FROM control_base UNION ALL "
    "SELECT url, iteration + 200000, stage, status, CAST(NULL AS VARCHAR), is_claimed, worker_id, lease_until, "
    "source_file, notes, created_at, updated_at FROM control_fx_id WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'signup')",
    "control_base", "control_fx_id")


def control_nullgate(spark, sf_dir):
    """Control rows plus copies (new iterations) of signup rows with a NULL gate."""
    # in the fixture a signup event is a row with status SKIPPED, an error event one in ERROR
    copies = control_base(spark, sf_dir).where(F.col("status") == "SKIPPED").withColumn("iteration", F.col("iteration") + 200000).withColumn(
        "task_state", F.lit(None).cast("string"))
    return control_base(spark, sf_dir).unionByName(copies.select(*S.PIPELINE_CONTROL.columns))


@register("flt4_active", f"SELECT * FROM ({NULLGATE_SQL}) t WHERE task_state IS NULL OR task_state NOT IN ('SKIP','HOLD')")
def flt4_active(spark, sf_dir):
    """FLT4: broad active gate (NULL and PAUSED count as active)."""
    return control_nullgate(spark, sf_dir).where(P.active_gate())


@register("flt5_ready", f"SELECT * FROM ({NULLGATE_SQL}) t WHERE task_state = 'READY'")
def flt5_ready(spark, sf_dir):
    """FLT5: strict READY gate."""
    return control_nullgate(spark, sf_dir).where(P.ready_gate())


@register("flt7_include_list_all", with_fixtures(
    f"SELECT url, iteration FROM control_fx WHERE stage = 'WEB_PAGE' AND status IN ('NEW','ERROR','IN_PROGRESS') "
    f"AND {FLT1_SQL} AND url IN ({SIGNUP_URLS_SQL})", "control_fx"))
def flt7_include_list_all(spark, sf_dir):
    """FLT7 over the whole worklist."""
    wl = C.worklist(control_fx(spark, sf_dir), "WEB_PAGE", ["NEW", "ERROR", "IN_PROGRESS"], TEST_NOW)
    return P.include_urls(wl, signup_urls(spark, sf_dir))


@register("flt7_include_list", with_fixtures(
    f"SELECT w.url, w.iteration FROM (SELECT url, iteration FROM control_fx WHERE stage = 'WEB_PAGE' "
    f"AND status IN ('NEW','ERROR','IN_PROGRESS') AND {FLT1_SQL} ORDER BY created_at NULLS LAST, url, iteration "
    f"LIMIT 20) w WHERE w.url IN ({SIGNUP_URLS_SQL})", "control_fx"))
def flt7_include_list(spark, sf_dir):
    """FLT7 (Q5): an explicit worklist limit applies before the URL include list."""
    wl = C.worklist(control_fx(spark, sf_dir), "WEB_PAGE", ["NEW", "ERROR", "IN_PROGRESS"], TEST_NOW, max_rows=20)
    return P.include_urls(wl, signup_urls(spark, sf_dir))


# ---------------------------------------------------------------- AGG2–AGG8
@register("agg2_url_progress", with_fixtures(
    "SELECT url, CAST(SUM(transition_flag) AS BIGINT) AS finalized_steps, "
    "CAST(SUM(CASE WHEN decision_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS ready_now, "
    "CAST(COUNT(*) AS BIGINT) AS total_stages, (SUM(transition_flag) = COUNT(*)) AS is_final "
    "FROM control_fx GROUP BY url", "control_fx"))
def agg2_url_progress(spark, sf_dir):
    """AGG2: per-URL decision progress view."""
    return Q.url_progress(control_fx(spark, sf_dir))


@register("agg3_max_iteration", with_fixtures(
    "SELECT url, COALESCE(MAX(iteration), 0) AS max_iteration FROM control_fx GROUP BY url", "control_fx"))
def agg3_max_iteration(spark, sf_dir):
    """AGG3: highest iteration per URL."""
    return Q.max_iteration(control_fx(spark, sf_dir))


@register("agg4a_urls_by_filters", with_fixtures(
    "SELECT DISTINCT url FROM control_fx WHERE status IN ('COMPLETED','ERROR') AND stage IN ('WEB_PAGE','DONE') "
    "AND (task_state IS NULL OR task_state NOT IN ('SKIP','HOLD'))", "control_fx"))
def agg4a_urls_by_filters(spark, sf_dir):
    """AGG4a: distinct URLs by status/stage lists under the broad active gate (Q8: case fixed)."""
    return Q.urls_by_filters(control_fx(spark, sf_dir), status=["completed", "ERROR"], stage=["WEB_PAGE", "DONE"])


@register("agg4a_urls_top", with_fixtures(
    "SELECT url FROM control_fx WHERE status IN ('COMPLETED') AND (task_state IS NULL OR task_state NOT IN "
    "('SKIP','HOLD')) GROUP BY url ORDER BY MAX(updated_at) DESC NULLS LAST, url LIMIT 25", "control_fx"))
def agg4a_urls_top(spark, sf_dir):
    """AGG4a with a limit: the 25 URLs most recently updated (a top-k report)."""
    return Q.urls_by_filters(control_fx(spark, sf_dir), status="COMPLETED", limit=25)


@register("agg4b_urls_stage_status", with_fixtures(
    "SELECT DISTINCT url FROM control_fx WHERE stage = 'WEB_SUMMARY' AND status IN ('NEW','ERROR') "
    "AND task_state IN ('READY')", "control_fx"))
def agg4b_urls_stage_status(spark, sf_dir):
    """AGG4b: distinct URLs at a stage with listed statuses, READY gate."""
    return Q.urls_by_stage_and_status(control_fx(spark, sf_dir), "WEB_SUMMARY", status=["NEW", "ERROR"])


@register("agg4b_urls_iteration", with_fixtures(
    "SELECT DISTINCT url FROM control_fx WHERE stage = 'URL' AND status IN ('NEW') AND task_state IN ('READY') "
    "AND iteration = 3", "control_fx"))
def agg4b_urls_iteration(spark, sf_dir):
    """AGG4b with the optional iteration filter."""
    return Q.urls_by_stage_and_status(control_fx(spark, sf_dir), "URL", status="NEW", iteration=3)


@register("agg4c_urls_by_status", with_fixtures(
    "SELECT DISTINCT url FROM control_fx WHERE status = 'ERROR'", "control_fx"))
def agg4c_urls_by_status(spark, sf_dir):
    """AGG4c: distinct URLs with one status."""
    return Q.urls_by_status(control_fx(spark, sf_dir), "ERROR")


@register("agg4d_urls_by_stage", with_fixtures(
    "SELECT DISTINCT url FROM control_fx WHERE stage = 'DONE'", "control_fx"))
def agg4d_urls_by_stage(spark, sf_dir):
    """AGG4d: distinct URLs at one stage."""
    return Q.urls_by_stage(control_fx(spark, sf_dir), "DONE")


@register("agg4e_registry_urls", with_fixtures("SELECT DISTINCT url FROM url_fx", "url_fx"))
def agg4e_registry_urls(spark, sf_dir):
    """AGG4e: distinct registry URLs."""
    return Q.registry_urls(url_fx(spark, sf_dir))


DUP_SQL = with_fixtures(
    f"SELECT {CONTROL_COLS} FROM control_base UNION ALL "
    "SELECT url, iteration, 'URL', status, task_state, is_claimed, worker_id, lease_until, source_file, notes, "
    "created_at - INTERVAL 1 DAY, CAST(NULL AS TIMESTAMP) FROM control_fx_id WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'error')",
    "control_base", "control_fx_id")


def control_with_dupes(spark, sf_dir):
    """Control rows plus an altered copy (same key) of every error row."""
    copies = (control_base(spark, sf_dir).where(F.col("status") == "ERROR").withColumn("stage", F.lit("URL"))
              .withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 1 DAYS"))
              .withColumn("updated_at", F.lit(None).cast("timestamp_ntz")))
    return control_base(spark, sf_dir).unionByName(copies.select(*S.PIPELINE_CONTROL.columns))


@register("agg5_pk_dupes", f"SELECT * FROM ({DUP_SQL}) d WHERE (url, iteration) IN "
          f"(SELECT (url, iteration) FROM ({DUP_SQL}) x GROUP BY url, iteration HAVING COUNT(*) > 1)")
def agg5_pk_dupes(spark, sf_dir):
    """AGG5: every member of each duplicate primary-key group."""
    return Q.pk_duplicates(control_with_dupes(spark, sf_dir), S.PIPELINE_CONTROL.primary_keys)


@register("agg6_first_per_pk", f"SELECT * FROM ({DUP_SQL}) d QUALIFY row_number() OVER (PARTITION BY url, iteration "
          "ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST) = 1")
def agg6_first_per_pk(spark, sf_dir):
    """AGG6: one row per key, newest first."""
    return Q.first_per_pk(control_with_dupes(spark, sf_dir), S.PIPELINE_CONTROL.primary_keys)


@register("agg7_exact_dedup", with_fixtures(
    f"SELECT DISTINCT * FROM (SELECT {CONTROL_COLS} FROM control_base UNION ALL SELECT {CONTROL_COLS} "
    "FROM control_fx_id WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'error')) t", "control_base", "control_fx_id"))
def agg7_exact_dedup(spark, sf_dir):
    """AGG7: exact-row dedup."""
    err = control_base(spark, sf_dir).where(F.col("status") == "ERROR")
    return Q.exact_dedup(control_base(spark, sf_dir).unionByName(err))


# every column of every row, NULL as \N, so that NULL and '' differ
GROUPED_SQL = ("SELECT url, CAST(iteration // 1000 AS BIGINT) AS part, CAST(COUNT(*) AS BIGINT) AS n_rows, string_agg(concat_ws('|', "
               + ", ".join(f"coalesce({'strftime(' + c + ', chr(37) || chr(89) || chr(45) || chr(37) || chr(109) || chr(45) || chr(37) || chr(100))' if c in ('lease_until', 'created_at', 'updated_at') else 'CAST(' + c + ' AS VARCHAR)'}, '\\N')"
                           for c in S.PIPELINE_CONTROL.columns) + "), ';' ORDER BY iteration) AS items FROM ({table}) t GROUP BY url, iteration // 1000")


def grouped_text(grouped):
    """The lists of objects as text (for comparison with SQL)."""
    def cell(x, c):
        day = c in ("lease_until", "created_at", "updated_at")
        return F.coalesce(F.date_format(x[c], "yyyy-MM-dd") if day else x[c].cast("string"), F.lit("\\N"))
    return grouped.withColumn("items", F.array_join(F.transform("items", lambda x: F.concat_ws(
        "|", *[cell(x, c) for c in S.PIPELINE_CONTROL.columns])), ";"))


@register("agg8_group_by_url", with_fixtures(
    GROUPED_SQL.format(table="control_base"), "control_base"))
def agg8_group_by_url(spark, sf_dir):
    """AGG8: each URL's rows, all columns, as one ordered list of objects (in parts by iteration range)."""
    return grouped_text(Q.group_by_url(control_base(spark, sf_dir)))


# ---------------------------------------------------------------- WIN1–WIN5
@register("win1_latest_state", with_fixtures(
    "SELECT * FROM control_fx QUALIFY row_number() OVER (PARTITION BY url ORDER BY "
    "COALESCE(updated_at, created_at, TIMESTAMP '1970-01-01') DESC, iteration DESC) = 1", "control_fx"))
def win1_latest_state(spark, sf_dir):
    """WIN1: latest control row per URL."""
    return Q.latest_state(control_fx(spark, sf_dir))


@register("win1_latest_ready", with_fixtures(
    "SELECT * FROM control_fx WHERE task_state = 'READY' QUALIFY row_number() OVER (PARTITION BY url ORDER BY "
    "COALESCE(updated_at, created_at, TIMESTAMP '1970-01-01') DESC, iteration DESC) = 1", "control_fx"))
def win1_latest_ready(spark, sf_dir):
    """WIN1 (active only): latest READY row per URL."""
    return Q.latest_state(control_fx(spark, sf_dir), ready_only=True)


PAGES_TWICE_SQL = with_fixtures(
    "SELECT * FROM web_page_fx UNION ALL SELECT url, iteration, status_code, html, 'stale', fetched_at, "
    "fetch_error, TIMESTAMP '2024-01-05 00:00:00', updated_at FROM web_page_fx", "web_page_fx")


def pages_twice(spark, sf_dir):
    w = web_page_fx(spark, sf_dir)
    old = w.withColumn("clean_text", F.lit("stale")).withColumn("created_at", ts("2024-01-05 00:00:00"))
    return w.unionByName(old)


@register("win2_newest_page", f"SELECT * FROM ({PAGES_TWICE_SQL}) p QUALIFY row_number() OVER "
          "(PARTITION BY url, iteration ORDER BY created_at DESC) = 1")
def win2_newest_page(spark, sf_dir):
    """WIN2: newest web_page row per (url, iteration)."""
    return Q.newest_page(pages_twice(spark, sf_dir))


@register("win3_highest_iteration", with_fixtures(
    "SELECT * FROM control_fx QUALIFY row_number() OVER (PARTITION BY url ORDER BY iteration DESC) = 1",
    "control_fx"))
def win3_highest_iteration(spark, sf_dir):
    """WIN3: highest-iteration row per URL."""
    return Q.highest_iteration(control_fx(spark, sf_dir))


@register("win4_newest_by_updated", with_fixtures(
    "SELECT * FROM control_fx QUALIFY row_number() OVER (PARTITION BY url ORDER BY updated_at DESC NULLS LAST, "
    "iteration DESC) = 1", "control_fx"))
def win4_newest_by_updated(spark, sf_dir):
    """WIN4: newest row per URL by updated_at."""
    return Q.newest_by_updated(control_fx(spark, sf_dir))


@register("win5_prefer_latest_only", with_fixtures(
    f"SELECT {CONTROL_COLS} FROM control_base QUALIFY row_number() OVER (PARTITION BY url ORDER BY iteration DESC, "
    "updated_at DESC NULLS LAST) = 1", "control_base"))
def win5_prefer_latest_only(spark, sf_dir):
    """WIN5: loader option prefer_latest_only (one row per key without iteration)."""
    return Q.prefer_latest_only(control_base(spark, sf_dir), S.PIPELINE_CONTROL)


# ---------------------------------------------------------------- SRT2/SRT3, PRJ3, SRC4–SRC7
@register("srt2_recent", with_fixtures(
    "SELECT url, stage, status, updated_at FROM control_fx ORDER BY updated_at DESC NULLS LAST, url, iteration "
    "LIMIT 10", "control_fx"))
def srt2_recent(spark, sf_dir):
    """SRT2: top-10 most recently updated rows."""
    return Q.recent(control_fx(spark, sf_dir), 10)


@register("srt3_loader_order", with_fixtures(
    "SELECT url, iteration, created_at FROM control_base WHERE task_state = 'HOLD' "
    "ORDER BY created_at ASC NULLS LAST", "control_base"))
def srt3_loader_order(spark, sf_dir):
    """SRT3: explicit order argument, unknown terms dropped."""
    return Q.load_table(control_base(spark, sf_dir), S.PIPELINE_CONTROL, order_by="created_at ASC, bogus DESC",
                        columns=["url", "iteration", "created_at"], task_state="HOLD")


@register("prj3_decision_state", with_fixtures(
    "SELECT url, stage, decision_flag, transition_flag, CASE WHEN decision_flag = 1 AND transition_flag = 0 "
    "THEN 'ready' WHEN transition_flag = 1 THEN 'final' ELSE 'undecided' END AS decision_state FROM control_fx",
    "control_fx"))
def prj3_decision_state(spark, sf_dir):
    """PRJ3: decision state view."""
    return decision_state(control_fx(spark, sf_dir))


@register("src4_load_table", with_fixtures(
    "SELECT url, iteration, stage FROM control_base WHERE stage = 'DONE' AND status = 'COMPLETED' "
    "ORDER BY updated_at DESC NULLS LAST", "control_base"))
def src4_load_table(spark, sf_dir):
    """SRC4: table load with filters and a column projection (pushed into the scan)."""
    return Q.load_table(control_base(spark, sf_dir), S.PIPELINE_CONTROL, columns=["url", "iteration", "stage"],
                        stage="DONE", status="COMPLETED")


@register("src5_select_by_url", with_fixtures(
    f"SELECT url, iteration, status FROM control_base WHERE url IN ({SIGNUP_URLS_SQL}) ORDER BY iteration DESC",
    "control_base"))
def src5_select_by_url(spark, sf_dir):
    """SRC5 (bulk): stable projection for a set of URLs."""
    return Q.select_for_urls(control_base(spark, sf_dir), S.PIPELINE_CONTROL, signup_urls(spark, sf_dir),
                             "url, iteration, status", order_by="iteration DESC")


@register("src6_control_rows", with_fixtures(
    f"SELECT * FROM control_base WHERE url IN ({SIGNUP_URLS_SQL}) QUALIFY row_number() OVER "
    "(PARTITION BY url ORDER BY iteration DESC) = 1", "control_base"))
def src6_control_rows(spark, sf_dir):
    """SRC6 (bulk): highest-iteration control row of each listed URL."""
    return Q.control_rows_for_urls(control_base(spark, sf_dir), signup_urls(spark, sf_dir),
                                   latest_iteration_only=True)


@register("src7_current_stage", with_fixtures(
    "SELECT url, stage FROM control_fx QUALIFY row_number() OVER (PARTITION BY url ORDER BY "
    "COALESCE(updated_at, created_at, TIMESTAMP '1970-01-01') DESC, iteration DESC) = 1", "control_fx"))
def src7_current_stage(spark, sf_dir):
    """SRC7: current stage per URL."""
    return Q.current_stage(control_fx(spark, sf_dir))


# ---------------------------------------------------------------- skew: one URL holds ~40% of all rows
HOT_URL = "https://u.example/hot"
HOT_SQL = with_fixtures(
    f"SELECT CASE WHEN e.event_type IN ('view', 'click') THEN '{HOT_URL}' ELSE c.url END AS url, "
    "CASE WHEN e.event_type IN ('view', 'click') THEN CAST(c.event_id AS INTEGER) ELSE c.iteration END AS iteration, "
    "c.stage, c.status, c.task_state, c.is_claimed, c.worker_id, c.lease_until, c.source_file, c.notes, "
    "c.created_at, c.updated_at FROM control_fx_id c JOIN events e ON c.event_id = e.event_id", "control_fx_id")


def control_hot(spark, sf_dir):
    """Control rows where every view/click event belongs to one URL (iteration = event id)."""
    c = control_fx(spark, sf_dir, with_event_id=True, with_flags=False)
    hot = F.col("status").isin("NEW", "COMPLETED")  # views and clicks
    return c.select(
        F.when(hot, F.lit(HOT_URL)).otherwise(F.col("url")).alias("url"),
        F.when(hot, F.col("event_id").cast("int")).otherwise(F.col("iteration")).alias("iteration"),
        *[c for c in S.PIPELINE_CONTROL.columns if c not in ("url", "iteration")])


@register("win1_latest_state_hot", f"SELECT * FROM ({HOT_SQL}) h QUALIFY row_number() OVER (PARTITION BY url ORDER BY "
          "COALESCE(updated_at, created_at, TIMESTAMP '1970-01-01') DESC, iteration DESC) = 1")
def win1_latest_state_hot(spark, sf_dir):
    """WIN1 with one hot URL (~40% of rows): partial group limit before the shuffle."""
    return Q.latest_state(control_hot(spark, sf_dir))


@register("agg8_group_by_url_hot", GROUPED_SQL.format(table=HOT_SQL))
def agg8_group_by_url_hot(spark, sf_dir):
    """AGG8 with one hot URL: its rows are cut into parts of at most 1,000."""
    return grouped_text(Q.group_by_url(control_hot(spark, sf_dir)))


@register("agg1_progress_hot", f"SELECT url = '{HOT_URL}' AS hot, stage, status, CAST(COUNT(*) AS BIGINT) AS count "
          f"FROM ({HOT_SQL}) h GROUP BY ALL")
def agg1_progress_hot(spark, sf_dir):
    """AGG1 split by hot/other URL: partial aggregation keeps the hot key off one task."""
    c = control_hot(spark, sf_dir)
    return c.groupBy((F.col("url") == HOT_URL).alias("hot"), "stage", "status").agg(F.count(F.lit(1)).alias("count"))


@register("src6_control_rows_hot", f"SELECT * FROM ({HOT_SQL}) h WHERE url = '{HOT_URL}' OR url IN ({SIGNUP_URLS_SQL}) "
          "QUALIFY row_number() OVER (PARTITION BY url ORDER BY iteration DESC) = 1")
def src6_control_rows_hot(spark, sf_dir):
    """SRC6 with one hot URL: the highest iteration is taken before the shuffle."""
    c = control_hot(spark, sf_dir)
    # the hot URL is in the list because rows of it are in the table
    hot = c.where(F.col("url") == HOT_URL).select("url").distinct()
    return Q.control_rows_for_urls(c, signup_urls(spark, sf_dir).unionByName(hot), latest_iteration_only=True)
