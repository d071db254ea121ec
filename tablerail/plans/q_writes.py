"""Registered write-side queries (M2): alignment, stamping, upserts, joins,
validation and coercion.  Each returns the resulting table with a fixed clock."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.functions import coerce as CO
from tablerail.operators import align as A
from tablerail.operators import predicates as P
from tablerail.operators import upsert as U
from tablerail.operators.queries import activity_key
from tablerail.plans.catalog import register
from tablerail.plans.fixtures import (control_base, control_fx, incoming_fx, raw_control_fx, read_table, url_fx,
                                      with_fixtures)
from tablerail.session import TEST_NOW

NOW = f"TIMESTAMP '{TEST_NOW}'"
CC = S.PIPELINE_CONTROL.columns
CONTROL_COLS = ", ".join(CC)
NON_KEY = [c for c in CC if c not in ("url", "iteration", "created_at", "updated_at")]

# the incoming batch after stamping and exact-duplicate removal
STAMPED = ("b", "SELECT url, iteration, stage, status, task_state, is_claimed, worker_id, lease_until, source_file, "
                f"notes, COALESCE(created_at, {NOW}) AS created_at, COALESCE(updated_at, {NOW}) AS updated_at "
                "FROM (SELECT DISTINCT * FROM incoming_fx) i")
MATCH = "x.url = b.url AND x.iteration = b.iteration"


def _sql(body, *extra, names=("control_base", "incoming_fx")):
    return with_fixtures(body, *names, extra=(STAMPED,) + tuple(extra))


UPDATED_SQL = ("SELECT x.url, x.iteration, " + ", ".join(f"b.{c}" for c in NON_KEY)
               + f", x.created_at, {NOW} AS updated_at FROM control_base x JOIN b ON {MATCH}")
UNTOUCHED_SQL = f"SELECT x.* FROM control_base x WHERE NOT EXISTS (SELECT 1 FROM b WHERE {MATCH})"
NEW_ONLY = f"SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM control_base x WHERE {MATCH})"


# ---------------------------------------------------------------- PRJ
@register("prj1_align", with_fixtures(
    "SELECT DISTINCT url, iteration, stage, status, task_state, is_claimed, worker_id, lease_until, source_file, "
    "CAST(NULL AS VARCHAR) AS notes, created_at, updated_at FROM incoming_fx", "incoming_fx"))
def prj1_align(spark, sf_dir):
    """PRJ1: extra column dropped, missing column added as NULL, reordered, exact duplicates dropped."""
    inc = incoming_fx(spark, sf_dir)
    messy = inc.drop("notes").withColumn("extra", F.lit(1)).select("extra", *reversed([c for c in CC if c != "notes"]))
    return A.align(messy.unionByName(messy), S.PIPELINE_CONTROL)


@register("prj1_defaults", with_fixtures(
    "SELECT DISTINCT url, 0 AS iteration, stage, 'NEW' AS status, 'READY' AS task_state, FALSE AS is_claimed, worker_id, "
    "lease_until, source_file, notes, created_at, updated_at FROM incoming_fx", "incoming_fx"))
def prj1_defaults(spark, sf_dir):
    """PRJ1: missing columns get the table's defaults (iteration, status, gate, claim)."""
    inc = incoming_fx(spark, sf_dir).drop("iteration", "status", "task_state", "is_claimed")
    return A.align(inc, S.PIPELINE_CONTROL)


@register("ups1_null_key_rejects", with_fixtures(
    "SELECT url, raw AS iteration, CASE WHEN url IS NULL THEN 'url is NULL' WHEN raw IS NULL THEN 'iteration is NULL' "
    "ELSE 'iteration is not a int' END AS reason FROM (SELECT CASE WHEN iteration % 7 = 0 THEN NULL ELSE url END AS url, "
    "CASE WHEN iteration % 5 = 0 THEN NULL WHEN iteration % 5 = 1 THEN 'abc' ELSE CAST(iteration AS VARCHAR) END AS raw "
    "FROM incoming_fx) t WHERE url IS NULL OR raw IS NULL OR raw = 'abc'", "incoming_fx"))
def ups1_null_key_rejects(spark, sf_dir):
    """UPS1: rows that no upsert accepts, with the key column at fault."""
    it = F.col("iteration")
    raw = incoming_fx(spark, sf_dir).select(
        F.when(it % 7 != 0, F.col("url")).alias("url"),
        F.when(it % 5 == 0, None).when(it % 5 == 1, "abc").otherwise(it.cast("string")).alias("iteration"))
    return U.key_rejects(raw, S.PIPELINE_CONTROL)


@register("prj2_align_strict", with_fixtures("SELECT DISTINCT * FROM incoming_fx", "incoming_fx"))
def prj2_align_strict(spark, sf_dir):
    """PRJ2: strict alignment of a complete batch (missing columns would raise)."""
    return A.align_strict(incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL)


@register("prj4_stamp", with_fixtures(
    f"SELECT url, iteration, stage, status, task_state, is_claimed, worker_id, lease_until, source_file, notes, "
    f"COALESCE(created_at, {NOW}) AS created_at, COALESCE(updated_at, {NOW}) AS updated_at FROM incoming_fx",
    "incoming_fx"))
def prj4_stamp(spark, sf_dir):
    """PRJ4: created_at/updated_at filled with one batch clock, only where NULL."""
    return A.stamp(incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW)


@register("prj5_iteration_from_control", with_fixtures(
    "SELECT u.url, COALESCE(m.mx, 0) AS iteration FROM (SELECT DISTINCT url FROM ("
    "SELECT url FROM incoming_fx UNION ALL SELECT url FROM url_fx) s) u "
    "LEFT JOIN (SELECT url, MAX(iteration) AS mx FROM control_base GROUP BY url) m ON u.url = m.url",
    "incoming_fx", "url_fx", "control_base"))
def prj5_iteration_from_control(spark, sf_dir):
    """PRJ5 (pipeline_control mode): a NULL iteration takes the URL's highest control iteration, else 0."""
    urls = (incoming_fx(spark, sf_dir).select("url").unionByName(url_fx(spark, sf_dir).select("url")).distinct()
            .withColumn("iteration", F.lit(None).cast("int")))
    return A.stamp_iteration(urls, "pipeline_control", control=control_base(spark, sf_dir)).select("url", "iteration")


@register("prj5_iteration_param", with_fixtures(
    "SELECT url, 7 AS iteration FROM url_fx", "url_fx"))
def prj5_iteration_param(spark, sf_dir):
    """PRJ5 (param mode): NULL iterations get the passed value."""
    urls = url_fx(spark, sf_dir).select("url", F.lit(None).cast("int").alias("iteration"))
    return A.stamp_iteration(urls, "param", value=7)


@register("prj7_add_metadata", with_fixtures(
    "SELECT url, source, tags, created_at, updated_at, 'pages.json' AS source_file, 0 AS iteration FROM url_fx",
    "url_fx"))
def prj7_add_metadata(spark, sf_dir):
    """PRJ7: metadata the control table owns and the frame lacks; existing columns untouched."""
    return A.add_metadata(url_fx(spark, sf_dir), S.PIPELINE_CONTROL, source_file="pages.json", llm_provider="x")


# ---------------------------------------------------------------- UPS / JN
@register("ups1_upsert", _sql(f"{UPDATED_SQL} UNION ALL {UNTOUCHED_SQL} UNION ALL "
                              f"SELECT b.* REPLACE ({NOW} AS updated_at) FROM b WHERE NOT EXISTS "
                              f"(SELECT 1 FROM control_base x WHERE {MATCH})"))
def ups1_upsert(spark, sf_dir):
    """UPS1: pk_scoped upsert."""
    return U.upsert(control_base(spark, sf_dir), incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW)


@register("ups1_upsert_bounded", _sql(f"{UPDATED_SQL} UNION ALL {UNTOUCHED_SQL} UNION ALL "
                                      f"SELECT b.* REPLACE ({NOW} AS updated_at) FROM b WHERE NOT EXISTS "
                                      f"(SELECT 1 FROM control_base x WHERE {MATCH})"))
def ups1_upsert_bounded(spark, sf_dir):
    """UPS1 of a batch whose every row comes twice: equal rows collapse in the key exchange."""
    inc = incoming_fx(spark, sf_dir)
    return U.upsert(control_base(spark, sf_dir), inc.unionByName(inc), S.PIPELINE_CONTROL, TEST_NOW)


@register("ups2_full_replace", _sql("SELECT * FROM b"))
def ups2_full_replace(spark, sf_dir):
    """UPS2: full replace – the stamped batch is the table."""
    return U.upsert(control_base(spark, sf_dir), incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW,
                    policy="full_replace")


@register("ups3_insert_new", _sql(f"SELECT * FROM control_base UNION ALL {NEW_ONLY}"))
def ups3_insert_new(spark, sf_dir):
    """UPS3: policy none – only keys not present are inserted."""
    return U.upsert(control_base(spark, sf_dir), incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW,
                    policy="none")


@register("ups4_replace_by_pk", _sql(f"{UNTOUCHED_SQL} UNION ALL SELECT * FROM b"))
def ups4_replace_by_pk(spark, sf_dir):
    """UPS4: delete matching keys, insert the batch (created_at not preserved)."""
    return U.upsert(control_base(spark, sf_dir), incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW,
                    policy="replace_by_pk")


@register("jn1_update_matched", _sql(UPDATED_SQL))
def jn1_update_matched(spark, sf_dir):
    """JN1: rows an upsert updates (inner equi-join), after the update."""
    return U.update_matched(control_base(spark, sf_dir), incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW)


@register("jn2_anti_insert", _sql(NEW_ONLY))
def jn2_anti_insert(spark, sf_dir):
    """JN2/JN3: batch rows whose key is absent (anti join)."""
    batch = U.prepare_batch(incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW)
    return U.insert_only_new(control_base(spark, sf_dir), batch, ["url", "iteration"])


@register("jn3_anti_insert_bounded", _sql(NEW_ONLY))
def jn3_anti_insert_bounded(spark, sf_dir):
    """JN3 with a bounded batch: its keys are broadcast to the table, which is not exchanged."""
    batch = U.prepare_batch(incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW)
    return U.insert_only_new_bounded(control_base(spark, sf_dir).where(F.col("url").isNotNull()), batch, ["url", "iteration"])


@register("jn4_delete_matching", _sql(UNTOUCHED_SQL))
def jn4_delete_matching(spark, sf_dir):
    """JN4: target rows whose key is in the batch are removed."""
    batch = U.prepare_batch(incoming_fx(spark, sf_dir), S.PIPELINE_CONTROL, TEST_NOW)
    return U.delete_matching(control_base(spark, sf_dir), batch, ["url", "iteration"])


# ---------------------------------------------------------------- VAL
@register("val1_batch_dupes", with_fixtures(
    "SELECT url, iteration, CAST(COUNT(*) AS BIGINT) AS n_rows FROM (SELECT url, iteration FROM incoming_fx "
    "UNION ALL SELECT url, iteration FROM incoming_fx WHERE url IN (SELECT DISTINCT concat('https://u.example/', "
    "user_id) FROM events WHERE event_type = 'signup')) t GROUP BY url, iteration HAVING COUNT(*) > 1",
    "incoming_fx"))
def val1_batch_dupes(spark, sf_dir):
    """VAL1: duplicate primary keys in an incoming batch (the keys an upsert refuses)."""
    inc = incoming_fx(spark, sf_dir)
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    hot = e.select(F.concat(F.lit("https://u.example/"), F.col("user_id").cast("string")).alias("url")).distinct()
    batch = inc.unionByName(inc.join(hot, "url", "left_semi").withColumn("notes", F.lit("copy")))
    return P.pk_duplicate_keys(batch, ["url", "iteration"])


BAD_FLAGS_SQL = with_fixtures(
    "SELECT url, iteration, decision_flag, transition_flag FROM control_fx UNION ALL "
    "SELECT url, iteration + 300000, CAST(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS TINYINT), "
    "CAST(CASE WHEN event_id % 2 = 0 THEN NULL ELSE 1 END AS TINYINT) FROM control_fx_id "
    "WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'error')", "control_fx", "control_fx_id")


def control_bad_flags(spark, sf_dir):
    c = control_fx(spark, sf_dir, with_event_id=True)
    err = c.where(F.col("status") == "ERROR")
    even = F.col("event_id") % 2 == 0
    bad = err.select("url", (F.col("iteration") + 300000).alias("iteration"),
                     F.when(even, 2).otherwise(1).cast("tinyint").alias("decision_flag"),
                     F.when(even, None).otherwise(1).cast("tinyint").alias("transition_flag"))
    return c.select("url", "iteration", "decision_flag", "transition_flag").unionByName(bad)


@register("val2_flag_violations",
          "SELECT url, iteration, decision_flag, transition_flag, check_name FROM ("
          f"SELECT *, 'decision_flag_domain' AS check_name FROM ({BAD_FLAGS_SQL}) t "
          "WHERE NOT COALESCE(decision_flag IS NULL OR decision_flag IN (0, 1), TRUE) UNION ALL "
          f"SELECT *, 'transition_flag_domain' FROM ({BAD_FLAGS_SQL}) t WHERE NOT COALESCE(transition_flag IN (0, 1), TRUE) "
          f"UNION ALL SELECT *, 'not_both_set' FROM ({BAD_FLAGS_SQL}) t "
          "WHERE NOT COALESCE(NOT (decision_flag = 1 AND transition_flag = 1), TRUE)) v")
def val2_flag_violations(spark, sf_dir):
    """VAL2: decision/transition flag checks as a violation report."""
    return P.flag_violations(control_bad_flags(spark, sf_dir))


# ---------------------------------------------------------------- CO / DT over raw_control_fx
RAW = "raw_control_fx"
WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


CO_SQL = {
    "iteration": f"COALESCE(TRY_CAST(TRUNC(TRY_CAST({_strip_sql('iteration')} AS DOUBLE)) AS INTEGER), 0)",
    "stage": f"upper({_strip_sql('stage')})",
    "status": f"CASE WHEN status IS NULL THEN 'NEW' ELSE upper({_strip_sql('status')}) END",
    "worker_id": f"NULLIF({_strip_sql('worker_id')}, '')",
    "lease_until": f"CASE WHEN {_strip_sql('lease_until')} = '' THEN NULL ELSE "
                   f"TRY_CAST({_strip_sql('lease_until')} AS TIMESTAMP) END",
    "url": _strip_sql("url"),
}
_TS = f"upper({_strip_sql('task_state')})"
_ST = CO_SQL["status"]
CO_SQL["task_state"] = (
    f"CASE WHEN (task_state IS NULL OR {_TS} = '') AND ({_ST}) IN ('COMPLETED', 'SKIPPED') THEN 'HOLD' "
    f"WHEN task_state IS NULL OR {_TS} = '' THEN 'READY' "
    + "".join(f"WHEN {_TS} = '{k}' THEN '{v}' " for k, v in S.LEGACY_TASK_STATE.items())
    + f"ELSE {_TS} END")
_CL = f"lower({_strip_sql('is_claimed')})"
CO_SQL["is_claimed"] = (
    f"CASE WHEN is_claimed IS NULL THEN FALSE WHEN {_CL} IN ('1','true','t','yes','y') THEN TRUE "
    f"WHEN {_CL} IN ('0','false','f','no','n') THEN FALSE "
    f"WHEN regexp_matches({_CL}, '^[+-]?[0-9]+$') THEN regexp_replace({_CL}, '^[+-]?0*', '') <> '' ELSE FALSE END")


def _co(name, fn):
    sql = with_fixtures(f"SELECT event_id, {name} AS raw, {CO_SQL[name]} AS value FROM {RAW}", RAW)

    def q(spark, sf_dir):
        r = raw_control_fx(spark, sf_dir)
        return r.select("event_id", F.col(name).alias("raw"), fn(r).alias("value"))
    q.__doc__ = f"Coercion of the control column {name} from dirty text."
    return register(f"co_{name}", sql)(q)


co1_iteration = _co("iteration", lambda r: CO.coerce_iteration("iteration"))
co2_stage = _co("stage", lambda r: CO.coerce_stage("stage"))
co3_status = _co("status", lambda r: CO.coerce_status("status"))
co4_task_state = _co("task_state", lambda r: CO.coerce_task_state("task_state", CO.coerce_status("status")))
co5_is_claimed = _co("is_claimed", lambda r: CO.coerce_claimed("is_claimed"))
co6_lease_until = _co("lease_until", lambda r: CO.coerce_timestamp("lease_until"))
co7_worker_id = _co("worker_id", lambda r: CO.coerce_worker("worker_id"))
co8_url = _co("url", lambda r: CO.coerce_url("url"))

CLEAN_SQL = with_fixtures(
    "SELECT " + ", ".join(f"{CO_SQL[c]} AS {c}" for c in ("url", "iteration", "stage", "status", "task_state",
                                                          "is_claimed", "worker_id", "lease_until"))
    + f", CAST(NULL AS VARCHAR) AS source_file, CAST(NULL AS VARCHAR) AS notes, {NOW} AS created_at, "
    "CAST(NULL AS TIMESTAMP) AS updated_at FROM raw_control_fx", RAW)
REASON_SQL = ("CASE WHEN url IS NULL THEN 'url' "
              "WHEN stage IS NULL OR stage NOT IN ('URL','WEB_PAGE','WEB_SUMMARY','DONE') THEN 'stage' "
              "WHEN status IS NULL OR status NOT IN ('NEW','IN_PROGRESS','COMPLETED','ERROR','SKIPPED') THEN 'status' "
              "WHEN task_state IS NULL OR task_state NOT IN ('READY','PAUSED','SKIP','HOLD') THEN 'task_state' END")


@register("co9_strip_strings", with_fixtures(
    f"SELECT event_id, {_strip_sql('stage')} AS stage, {_strip_sql('status')} AS status, "
    f"{_strip_sql('url')} AS url FROM raw_control_fx", RAW))
def co9_strip_strings(spark, sf_dir):
    """CO9: whitespace stripped on every string column."""
    return CO.strip_strings(raw_control_fx(spark, sf_dir).select("event_id", "stage", "status", "url"))


@register("co10_clean_control", f"SELECT *, {REASON_SQL} AS reject_reason FROM ({CLEAN_SQL}) c")
def co10_clean_control(spark, sf_dir):
    """CO10: whole-row control clean-up with a reject reason per row."""
    return CO.clean_control(raw_control_fx(spark, sf_dir).drop("event_id"), TEST_NOW)


BAD_ENUM_SQL = with_fixtures(
    "SELECT url, iteration, stage, status, task_state FROM control_base UNION ALL "
    "SELECT url, iteration + 400000, CASE WHEN event_id % 2 = 0 THEN 'ARCHIVE' ELSE stage END, "
    "CASE WHEN event_id % 3 = 0 THEN 'LOST' ELSE status END, 'MAYBE' FROM control_fx_id "
    "WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'signup')", "control_base", "control_fx_id")


@register("val3_enum_rejects", "SELECT *, CASE WHEN stage IS NULL OR stage NOT IN ('URL','WEB_PAGE','WEB_SUMMARY',"
          "'DONE') THEN 'stage' WHEN status IS NULL OR status NOT IN ('NEW','IN_PROGRESS','COMPLETED','ERROR',"
          "'SKIPPED') THEN 'status' WHEN task_state IS NULL OR task_state NOT IN ('READY','PAUSED','SKIP','HOLD') "
          f"THEN 'task_state' END AS reason FROM ({BAD_ENUM_SQL}) t WHERE NOT (stage IN ('URL','WEB_PAGE',"
          "'WEB_SUMMARY','DONE') AND status IN ('NEW','IN_PROGRESS','COMPLETED','ERROR','SKIPPED') AND "
          "task_state IN ('READY','PAUSED','SKIP','HOLD'))")
def val3_enum_rejects(spark, sf_dir):
    """VAL3: rows whose stage/status/task_state are not members, with the first failing field."""
    c = control_fx(spark, sf_dir, with_event_id=True, with_flags=False)
    bad = (c.where(F.col("status") == "SKIPPED").select("url", (F.col("iteration") + 400000).alias("iteration"),
                   F.when(F.col("event_id") % 2 == 0, "ARCHIVE").otherwise(F.col("stage")).alias("stage"),
                   F.when(F.col("event_id") % 3 == 0, "LOST").otherwise(F.col("status")).alias("status"),
                   F.lit("MAYBE").alias("task_state")))
    rows = control_base(spark, sf_dir).select("url", "iteration", "stage", "status", "task_state").unionByName(bad)
    return P.split_enum_valid(rows)[1]


@register("dt2_created_at_or_now", with_fixtures(
    f"SELECT event_id, COALESCE(TRY_CAST(lease_until AS TIMESTAMP), {NOW}) AS created_at FROM raw_control_fx", RAW))
def dt2_created_at_or_now(spark, sf_dir):
    """DT2: tolerant created_at cast, unparsable → now."""
    r = raw_control_fx(spark, sf_dir)
    return r.select("event_id", CO.created_at_or_now("lease_until", TEST_NOW).alias("created_at"))


DATE_TEXT_SQL = ("SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d') "
                 "WHEN 1 THEN strftime(ts, '%b %d, %Y') WHEN 2 THEN strftime(ts, '%B %-d, %Y') "
                 "WHEN 3 THEN 'n/a ' || event_type ELSE strftime(ts, '%d.%m.%Y') END AS posted FROM events")


@register("dt3_parse_dates", f"SELECT event_id, posted, COALESCE(TRY_CAST(posted AS DATE), "
          "CAST(TRY_STRPTIME(posted, '%b %d, %Y') AS DATE), CAST(TRY_STRPTIME(posted, '%B %d, %Y') AS DATE)) "
          f"AS posted_date FROM ({DATE_TEXT_SQL}) d")
def dt3_parse_dates(spark, sf_dir):
    """DT3: multi-format date parse (ISO, 'Jan 02, 2024', 'January 2, 2024'); others → NULL."""
    e = read_table(spark, sf_dir, "events")
    m = F.col("event_id") % 5
    txt = (F.when(m == 0, F.date_format("ts", "yyyy-MM-dd")).when(m == 1, F.date_format("ts", "MMM dd, yyyy"))
           .when(m == 2, F.date_format("ts", "MMMM d, yyyy")).when(m == 3, F.concat(F.lit("n/a "), F.col("event_type")))
           .otherwise(F.date_format("ts", "dd.MM.yyyy")))
    d = e.select("event_id", txt.alias("posted"))
    return d.withColumn("posted_date", CO.parse_date("posted"))


@register("dt4_activity_key", with_fixtures(
    "SELECT url, iteration, COALESCE(updated_at, created_at, TIMESTAMP '1970-01-01') AS activity FROM control_base",
    "control_base"))
def dt4_activity_key(spark, sf_dir):
    """DT4: latest-activity key."""
    return control_base(spark, sf_dir).select("url", "iteration", activity_key().alias("activity"))
