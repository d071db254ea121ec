"""Registered control-plane queries (M3): leases, transitions, sync, URL runner."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators import control as C
from tablerail.plans import runs as R
from tablerail.plans.catalog import register
from tablerail.plans.fixtures import control_base, url_fx, with_fixtures
from tablerail.plans.q_reads import HOT_SQL, SIGNUP_URLS_SQL, control_hot, signup_urls
from tablerail.session import TEST_NOW, TEST_WORKER

NOW = f"TIMESTAMP '{TEST_NOW}'"
CC = S.PIPELINE_CONTROL.columns
FREE = f"(is_claimed = FALSE OR lease_until IS NULL OR lease_until < {NOW})"
WS_END = r"'[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$'"


def _select(overrides: dict, cond: str, table: str = "control_base") -> str:
    """SQL: every control column, ``overrides`` applied where ``cond`` holds."""
    parts = []
    for c in CC:
        if c in overrides:
            parts.append(f"CASE WHEN {cond} THEN {overrides[c]} ELSE {c} END AS {c}")
        else:
            parts.append(c)
    return f"SELECT {', '.join(parts)} FROM {table}"


def _note_sql(note: str) -> str:
    line = f"'[2024-01-15T00:00:00] {note}'"
    return (f"CASE WHEN notes IS NULL OR notes = '' THEN {line} "
            f"ELSE regexp_replace({line} || chr(10) || notes, {WS_END}, '') END")


GATE_NEW = "CASE WHEN task_state IN ('SKIP','PAUSED','HOLD') THEN task_state ELSE 'READY' END"
RELEASED = {"is_claimed": "FALSE", "worker_id": "CAST(NULL AS VARCHAR)", "lease_until": "CAST(NULL AS TIMESTAMP)"}
NEXT_SQL = ("CASE stage WHEN 'URL' THEN 'WEB_PAGE' WHEN 'WEB_PAGE' THEN 'WEB_SUMMARY' "
            "WHEN 'WEB_SUMMARY' THEN 'DONE' END")


def _keys(control, stage):
    return control.where(F.col("stage") == stage).select("url", "iteration")


# ---------------------------------------------------------------- LSE / JN7 / DT1
CLAIM = {"is_claimed": "TRUE", "worker_id": f"'{TEST_WORKER}'", "lease_until": f"{NOW} + INTERVAL 15 MINUTE",
         "status": "'IN_PROGRESS'", "updated_at": NOW}
CLAIM_COND = f"stage = 'WEB_PAGE' AND task_state = 'READY' AND {FREE}"


@register("lse1_claim", with_fixtures(_select(CLAIM, CLAIM_COND), "control_base"))
def lse1_claim(spark, sf_dir):
    """LSE1 + JN7: claim every WEB_PAGE key (gate and lease tested, not status: Q3)."""
    c = control_base(spark, sf_dir)
    return C.claim(c, _keys(c, "WEB_PAGE"), TEST_WORKER, TEST_NOW).control


@register("lse1_claimed_rows", with_fixtures(f"SELECT * FROM ({_select(CLAIM, CLAIM_COND)}) t WHERE "
                                             f"worker_id = '{TEST_WORKER}'", "control_base"))
def lse1_claimed_rows(spark, sf_dir):
    """LSE1: the rows a claim took (RETURNING *)."""
    c = control_base(spark, sf_dir)
    return C.claim(c, _keys(c, "WEB_PAGE"), TEST_WORKER, TEST_NOW).rows


LSE1_BOUNDED_SQL = with_fixtures(
    _select(CLAIM, f"(url, iteration) IN (SELECT (url, iteration) FROM (SELECT url, iteration FROM control_base "
                   f"WHERE stage = 'WEB_PAGE' AND status IN ('NEW') AND task_state = 'READY' AND {FREE} "
                   "ORDER BY created_at NULLS LAST, url, iteration LIMIT 20) w) "
                   f"AND task_state = 'READY' AND {FREE}"), "control_base")


@register("lse1_claim_bounded", LSE1_BOUNDED_SQL)
def lse1_claim_bounded(spark, sf_dir):
    """WRK1 → LSE1 with an explicit batch of 20 keys."""
    c = control_base(spark, sf_dir)
    wl = C.worklist(c, "WEB_PAGE", ["NEW"], TEST_NOW, max_rows=20)
    return C.claim(c, wl, TEST_WORKER, TEST_NOW).control


@register("lse1_claim_dup_keys", with_fixtures(_select(CLAIM, CLAIM_COND), "control_base"))
def lse1_claim_dup_keys(spark, sf_dir):
    """LSE1 with a key list that names every key twice: each row is still updated once."""
    c = control_base(spark, sf_dir)
    keys = _keys(c, "WEB_PAGE")
    return C.claim(c, keys.unionAll(keys), TEST_WORKER, TEST_NOW).control


@register("dt1_lease_expiry", with_fixtures(
    f"SELECT url, iteration, lease_until FROM ({_select(CLAIM, CLAIM_COND)}) t WHERE worker_id = '{TEST_WORKER}'",
    "control_base"))
def dt1_lease_expiry(spark, sf_dir):
    """DT1: lease expiry = now + 15 minutes on claimed rows."""
    return lse1_claimed_rows(spark, sf_dir).select("url", "iteration", "lease_until")


@register("lse2_renew", with_fixtures(_select(
    {"lease_until": f"{NOW} + INTERVAL 30 MINUTE", "updated_at": NOW},
    "stage = 'DONE' AND worker_id = 'w-1' AND is_claimed = TRUE"), "control_base"))
def lse2_renew(spark, sf_dir):
    """LSE2: holder-only renew (expiry itself not tested)."""
    c = control_base(spark, sf_dir)
    return C.renew(c, _keys(c, "DONE"), "w-1", TEST_NOW, lease_minutes=30).control


@register("lse3_release", with_fixtures(_select(
    {**RELEASED, "status": "'COMPLETED'", "updated_at": NOW}, "status = 'IN_PROGRESS' AND worker_id = 'w-2'"),
    "control_base"))
def lse3_release(spark, sf_dir):
    """LSE3: holder-only release with one final status."""
    c = control_base(spark, sf_dir)
    keys = c.where(F.col("status") == "IN_PROGRESS").select("url", "iteration")
    return C.release(c, keys, "w-2", TEST_NOW, final_status="COMPLETED").control


@register("lse3_release_per_key", with_fixtures(_select(
    {**RELEASED, "status": "CASE WHEN iteration % 2 = 0 THEN 'COMPLETED' ELSE 'ERROR' END", "updated_at": NOW},
    "status = 'IN_PROGRESS' AND worker_id = 'w-3'"), "control_base"))
def lse3_release_per_key(spark, sf_dir):
    """LSE3 with a final status per key."""
    c = control_base(spark, sf_dir)
    keys = c.where(F.col("status") == "IN_PROGRESS").select(
        "url", "iteration", F.when(F.col("iteration") % 2 == 0, "COMPLETED").otherwise("ERROR").alias("final_status"))
    return C.release(c, keys, "w-3", TEST_NOW).control


FIN_HIT = "stage = 'WEB_SUMMARY'"
FIN_NOTE = "CASE WHEN status <> 'ERROR' THEN 'finalized ok' END"
FIN_HOLDER = f"{FIN_HIT} AND worker_id = 'w-4'"
FIN_SQL = ("SELECT url, iteration, "
           f"CASE WHEN {FIN_HOLDER} THEN CASE WHEN status <> 'ERROR' THEN 'COMPLETED' ELSE 'ERROR' END ELSE status END "
           "AS status, stage, task_state, "
           f"CASE WHEN {FIN_HOLDER} THEN FALSE ELSE is_claimed END AS is_claimed, "
           f"CASE WHEN {FIN_HOLDER} THEN NULL ELSE worker_id END AS worker_id, "
           f"CASE WHEN {FIN_HOLDER} THEN NULL ELSE lease_until END AS lease_until, source_file, "
           f"CASE WHEN {FIN_HIT} AND {FIN_NOTE} IS NOT NULL THEN {FIN_NOTE} ELSE notes END AS notes, created_at, "
           f"CASE WHEN {FIN_HOLDER} OR ({FIN_HIT} AND {FIN_NOTE} IS NOT NULL) THEN {NOW} ELSE updated_at END "
           "AS updated_at FROM control_base")


@register("lse4_finalize", with_fixtures(FIN_SQL, "control_base"))
def lse4_finalize(spark, sf_dir):
    """LSE4: notes written for every listed key, lease released for the holder only (Q15)."""
    c = control_base(spark, sf_dir)
    ok = F.col("status") != "ERROR"
    keys = c.where(F.col("stage") == "WEB_SUMMARY").select(
        "url", "iteration", ok.alias("ok"), F.when(ok, F.lit("finalized ok")).alias("notes"))
    return C.finalize(c, keys, "w-4", TEST_NOW).control


# ---------------------------------------------------------------- FSM
@register("fsm1_next_prev", with_fixtures(
    f"SELECT url, iteration, stage, {NEXT_SQL} AS next_stage, CASE stage WHEN 'WEB_PAGE' THEN 'URL' "
    "WHEN 'WEB_SUMMARY' THEN 'WEB_PAGE' WHEN 'DONE' THEN 'WEB_SUMMARY' END AS prev_stage FROM control_base",
    "control_base"))
def fsm1_next_prev(spark, sf_dir):
    """FSM1: next / previous stage on the rail (NULL at the ends)."""
    return control_base(spark, sf_dir).select("url", "iteration", "stage", C.next_stage().alias("next_stage"),
                                              C.prev_stage().alias("prev_stage"))


@register("fsm2_mark_status", with_fixtures(
    f"SELECT url, iteration, stage, 'NEW' AS status, {GATE_NEW} AS task_state, is_claimed, worker_id, lease_until, "
    f"source_file, {_note_sql('retry requested')} AS notes, created_at, {NOW} AS updated_at "
    "FROM control_base WHERE status = 'ERROR'", "control_base"))
def fsm2_mark_status(spark, sf_dir):
    """FSM2: mark ERROR rows NEW with a timestamped note; gate normalised."""
    rows = control_base(spark, sf_dir).where(F.col("status") == "ERROR")
    return C.mark_status(rows, "NEW", TEST_NOW, note="retry requested")


STEP_SQL = (
    "SELECT url, iteration, "
    f"CASE WHEN stage = 'DONE' THEN stage ELSE {NEXT_SQL} END AS stage, "
    "CASE WHEN stage = 'DONE' THEN status ELSE 'NEW' END AS status, "
    "CASE WHEN stage = 'DONE' OR stage = 'WEB_SUMMARY' THEN 'PAUSED' ELSE 'READY' END AS task_state, "
    "FALSE AS is_claimed, CAST(NULL AS VARCHAR) AS worker_id, CAST(NULL AS TIMESTAMP) AS lease_until, "
    f"source_file, notes, created_at, {NOW} AS updated_at FROM control_base WHERE task_state = 'READY'")


@register("fsm3_step", with_fixtures(STEP_SQL, "control_base"))
def fsm3_step(spark, sf_dir):
    """FSM3: step on READY rows (§2.9.1)."""
    return C.step(control_base(spark, sf_dir).where(F.col("task_state") == "READY"), TEST_NOW)


@register("fsm4_gate", with_fixtures(
    "SELECT url, iteration, CASE WHEN task_state IN ('SKIP','PAUSED','HOLD') THEN task_state "
    "WHEN status = 'COMPLETED' AND stage = 'DONE' THEN 'PAUSED' ELSE 'READY' END AS gate FROM control_base",
    "control_base"))
def fsm4_gate(spark, sf_dir):
    """FSM4: gate normalisation on persist."""
    return control_base(spark, sf_dir).select(
        "url", "iteration", C.normalized_gate(F.col("stage"), F.col("status"), F.col("task_state")).alias("gate"))


@register("fsm5_persist_step", with_fixtures(
    f"SELECT * FROM control_base WHERE task_state IS DISTINCT FROM 'READY' UNION ALL SELECT * FROM ({STEP_SQL}) s",
    "control_base"))
def fsm5_persist_step(spark, sf_dir):
    """FSM5: stepped READY rows persisted back (FSM4 → UPS1) into the whole table."""
    c = control_base(spark, sf_dir)
    stepped = C.step(c.where(F.col("task_state") == "READY"), TEST_NOW)
    return C.persist_states(c, stepped, TEST_NOW)


LATEST_UPD = ("(url, iteration) IN (SELECT (url, iteration) FROM control_base QUALIFY row_number() OVER "
              "(PARTITION BY url ORDER BY updated_at DESC NULLS LAST, iteration DESC) = 1)")


@register("fsm6_advance_completed", with_fixtures(_select(
    {"stage": NEXT_SQL, "status": "'NEW'", "task_state": GATE_NEW, "updated_at": NOW},
    f"{LATEST_UPD} AND status = 'COMPLETED' AND stage <> 'DONE'"), "control_base"))
def fsm6_advance_completed(spark, sf_dir):
    """FSM6: each URL's newest row, when COMPLETED, moves one stage (gate only normalised)."""
    return C.advance_completed(control_base(spark, sf_dir), TEST_NOW).control


@register("fsm7_retry_errors", with_fixtures(_select(
    {"status": "'NEW'", "task_state": GATE_NEW, "notes": _note_sql(C.RETRY_NOTE), "updated_at": NOW},
    f"{LATEST_UPD} AND status = 'ERROR'"), "control_base"))
def fsm7_retry_errors(spark, sf_dir):
    """FSM7: each URL's newest row, when in ERROR, back to NEW at the same stage with a note."""
    return C.retry_errors(control_base(spark, sf_dir), TEST_NOW).control


FSM8_TARGET = (
    "(url, iteration) IN (SELECT (url, iteration) FROM control_base WHERE task_state = 'READY' AND url IN "
    "(SELECT url FROM control_base WHERE status = 'COMPLETED' AND (task_state IS NULL OR task_state NOT IN "
    "('SKIP','HOLD'))) QUALIFY row_number() OVER (PARTITION BY url ORDER BY COALESCE(updated_at, created_at, "
    "TIMESTAMP '1970-01-01') DESC, iteration DESC) = 1)")


@register("fsm8_advance_all", with_fixtures(_select(
    {"stage": f"CASE WHEN stage = 'DONE' THEN stage ELSE {NEXT_SQL} END",
     "status": "CASE WHEN stage = 'DONE' THEN status ELSE 'NEW' END",
     "task_state": "CASE WHEN stage IN ('DONE', 'WEB_SUMMARY') THEN 'PAUSED' ELSE 'READY' END",
     **RELEASED, "updated_at": NOW}, FSM8_TARGET), "control_base"))
def fsm8_advance_all(spark, sf_dir):
    """FSM8: URLs with an active COMPLETED row → latest READY row stepped."""
    return C.advance_all_completed(control_base(spark, sf_dir), TEST_NOW).control


# ---------------------------------------------------------------- SYNC / JN5 / FLT6
SYNC_NEW = (f"SELECT url, 0 AS iteration, 'URL' AS stage, 'NEW' AS status, 'READY' AS task_state, FALSE AS is_claimed, "
            "CAST(NULL AS VARCHAR) AS worker_id, CAST(NULL AS TIMESTAMP) AS lease_until, CAST(NULL AS VARCHAR) AS "
            f"source_file, CAST(NULL AS VARCHAR) AS notes, {NOW} AS created_at, {NOW} AS updated_at FROM ")
REGISTRY_SQL = f"(SELECT url FROM url_fx UNION SELECT url FROM ({SIGNUP_URLS_SQL}) s)"


def registry(spark, sf_dir):
    """Registry: the pages' URLs plus the URLs of users who signed up."""
    u = url_fx(spark, sf_dir)
    return u.unionByName(signup_urls(spark, sf_dir).select(
        "url", *[F.lit(None).cast(u.schema[c].dataType).alias(c) for c in u.columns if c != "url"]))


@register("sync1_append", with_fixtures(
    f"SELECT * FROM control_base UNION ALL {SYNC_NEW} {REGISTRY_SQL} r WHERE url NOT IN "
    "(SELECT url FROM control_base WHERE iteration = 0)", "control_base", "url_fx"))
def sync1_append(spark, sf_dir):
    """SYNC1 (append): registry URLs without a control row at iteration 0 get one (URL/NEW/READY)."""
    return C.sync_from_registry(registry(spark, sf_dir), control_base(spark, sf_dir), TEST_NOW)


@register("sync1_replace", with_fixtures(
    f"SELECT * FROM control_base WHERE iteration <> 0 UNION ALL {SYNC_NEW} {REGISTRY_SQL} r",
    "control_base", "url_fx"))
def sync1_replace(spark, sf_dir):
    """SYNC1 (replace): rows of iteration 0 dropped, every registry URL inserted."""
    return C.sync_from_registry(registry(spark, sf_dir), control_base(spark, sf_dir), TEST_NOW, mode="replace")


@register("jn5_registry_anti", with_fixtures(
    f"SELECT url FROM {REGISTRY_SQL} r WHERE url NOT IN (SELECT url FROM control_base WHERE iteration = 0)",
    "control_base", "url_fx"))
def jn5_registry_anti(spark, sf_dir):
    """JN5: registry URLs missing from control at iteration 0 (anti join)."""
    existing = control_base(spark, sf_dir).where(F.col("iteration") == 0).select("url")
    return registry(spark, sf_dir).select("url").distinct().join(existing, "url", "left_anti")


@register("flt6_wrong_stage", with_fixtures(
    f"SELECT url, iteration, stage FROM control_base WHERE status = 'NEW' AND task_state = 'READY' AND {FREE} "
    "AND stage <> 'WEB_PAGE'", "control_base"))
def flt6_wrong_stage(spark, sf_dir):
    """FLT6: claimed rows (all READY/NEW, any stage) not at the runner's stage – released as ERROR."""
    c = control_base(spark, sf_dir)
    keys = c.where(F.col("status") == "NEW").select("url", "iteration")
    claimed = C.claim(c, keys, TEST_WORKER, TEST_NOW).rows
    return C.stage_gate(claimed, "WEB_PAGE")[1].select("url", "iteration", "stage")


# ---------------------------------------------------------------- RUN1 / AGG9
RUN1_COND = f"stage = 'URL' AND status = 'NEW' AND task_state = 'READY' AND {FREE}"


@register("run1_url_stage", with_fixtures(_select(
    {"stage": "'WEB_PAGE'", "status": "'NEW'", "task_state": "'READY'", **RELEASED,
     "notes": _note_sql(R.URL_DONE_NOTE), "updated_at": NOW}, RUN1_COND), "control_base"))
def run1_url_stage(spark, sf_dir):
    """RUN1: URL runner over the whole table (no batch cap)."""
    return R.run_url_stage(control_base(spark, sf_dir), TEST_NOW, TEST_WORKER).control


@register("agg9_run_counters", with_fixtures(
    f"SELECT CAST(COUNT(*) AS BIGINT) AS found, CAST(COUNT(*) AS BIGINT) AS claimed, CAST(COUNT(*) AS BIGINT) AS "
    f"completed, CAST(COUNT(*) AS BIGINT) AS enqueued_next FROM control_base WHERE {RUN1_COND}", "control_base"))
def agg9_run_counters(spark, sf_dir):
    """AGG9: found / claimed / completed / enqueued_next of a URL-runner pass."""
    return R.run_url_stage(control_base(spark, sf_dir), TEST_NOW, TEST_WORKER).counters()


@register("agg9_run_counters_race", with_fixtures(
    f"SELECT CAST(COUNT(*) AS BIGINT) AS found, CAST(COUNT(*) FILTER (WHERE notes IS NULL) AS BIGINT) AS claimed, "
    f"CAST(COUNT(*) FILTER (WHERE notes IS NULL) AS BIGINT) AS completed, "
    f"CAST(COUNT(*) FILTER (WHERE notes IS NULL) AS BIGINT) AS enqueued_next FROM control_base WHERE {RUN1_COND}",
    "control_base"))
def agg9_run_counters_race(spark, sf_dir):
    """AGG9 with lost races: between listing and claiming another worker leases every listed row that has notes."""
    c = control_base(spark, sf_dir)
    raced = C.update_where(c, F.col("notes").isNotNull(), {
        "is_claimed": F.lit(True), "worker_id": F.lit("w-other"),
        "lease_until": C.lease_expiry(TEST_NOW, 60)})
    return R.run_url_stage(c, TEST_NOW, TEST_WORKER, claim_view=raced).counters()


FSM6_HOT_SQL = "WITH hot AS (" + HOT_SQL + ") " + _select(
    {"stage": NEXT_SQL, "status": "'NEW'", "task_state": GATE_NEW, "updated_at": NOW},
    "(url, iteration) IN (SELECT (url, iteration) FROM hot QUALIFY row_number() OVER (PARTITION BY url "
    "ORDER BY updated_at DESC NULLS LAST, iteration DESC) = 1) AND status = 'COMPLETED' AND stage <> 'DONE'",
    table="hot")


@register("fsm6_advance_completed_hot", FSM6_HOT_SQL)
def fsm6_advance_completed_hot(spark, sf_dir):
    """FSM6 with one hot URL: keyed update joins on (url, iteration), so the hot URL spreads."""
    return C.advance_completed(control_hot(spark, sf_dir), TEST_NOW).control


FSM8_HOT_SQL = "WITH hot AS (" + HOT_SQL + ") " + _select(
    {"stage": f"CASE WHEN stage = 'DONE' THEN stage ELSE {NEXT_SQL} END",
     "status": "CASE WHEN stage = 'DONE' THEN status ELSE 'NEW' END",
     "task_state": "CASE WHEN stage IN ('DONE', 'WEB_SUMMARY') THEN 'PAUSED' ELSE 'READY' END",
     **RELEASED, "updated_at": NOW}, FSM8_TARGET.replace("control_base", "hot"), table="hot")


@register("fsm8_advance_all_hot", FSM8_HOT_SQL)
def fsm8_advance_all_hot(spark, sf_dir):
    """FSM8 with one hot URL: one row per URL is chosen before the shuffle."""
    return C.advance_all_completed(control_hot(spark, sf_dir), TEST_NOW).control
