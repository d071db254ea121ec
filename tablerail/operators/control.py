"""Control-plane operators on the ``pipeline_control`` table (WRK1, LSE1–LSE4,
FSM1–FSM8, SYNC1, JN5, JN7, FLT6).

Every operator takes the control DataFrame and an explicit ``now`` and returns
the next version of the table (plus, where useful, the affected rows).  A
claim, release or step that the reference runs as one SQL ``UPDATE`` per URL
is here one keyed pass over the whole table.

Key sets are joined on the full primary key (url, iteration), which spreads a
hot URL over all partitions.  There is one plan for every size: the adaptive
planner broadcasts a key set it has measured to be small."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.functions.text import prepend_note, strip_ws
from tablerail.operators.predicates import claimable, lease_free, ready_gate
from tablerail.operators.queries import newest_by_updated, urls_by_filters, latest_state
from tablerail.operators.upsert import prepare_batch, upsert
from tablerail.session import ts

PK = ["url", "iteration"]


class Updated(NamedTuple):
    control: DataFrame
    rows: DataFrame  # the affected rows, after the change


# ---------------------------------------------------------------------------
# Row-level expressions
# ---------------------------------------------------------------------------

def next_stage(col: str | Column = "stage") -> Column:
    """FSM1: next stage on the rail; NULL at the end or for unknown stages."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for cur, nxt in S.NEXT_STAGE.items():
        if nxt is None:
            continue
        expr = F.when(c == cur, F.lit(nxt)) if expr is None else expr.when(c == cur, F.lit(nxt))
    return expr


def prev_stage(col: str | Column = "stage") -> Column:
    """FSM1: previous stage; NULL at the start."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for cur, prv in S.PREV_STAGE.items():
        if prv is None:
            continue
        expr = F.when(c == cur, F.lit(prv)) if expr is None else expr.when(c == cur, F.lit(prv))
    return expr


def normalized_gate(stage: Column, status: Column, task_state: Column) -> Column:
    """FSM4: gate on persist – SKIP/PAUSED/HOLD kept; COMPLETED at the final stage
    → PAUSED; anything else → READY."""
    return (F.when(task_state.isin(*S.STICKY_GATES), task_state)
            .when((status == "COMPLETED") & (stage == S.FINAL_STAGE), F.lit("PAUSED"))
            .otherwise(F.lit("READY")))


def _cleared_lease() -> dict:
    return {"is_claimed": F.lit(False), "worker_id": F.lit(None).cast("string"),
            "lease_until": F.lit(None).cast("timestamp_ntz")}


def mark_status_values(status: str | Column, now, note: str | None = None) -> dict:
    """FSM2: new status, note prepended, gate normalised, ``updated_at = now``."""
    st = F.lit(status) if isinstance(status, str) else status
    return {
        "status": st,
        "notes": prepend_note("notes", ts(now), note),
        "task_state": normalized_gate(F.col("stage"), st, F.col("task_state")),
        "updated_at": ts(now),
    }


def step_values(now) -> tuple[Column, dict]:
    """FSM3 (§2.9.1): returns (changes?, new values).

    Not final: next stage, NEW, PAUSED when landing on the final stage else
    READY, lease cleared.  Final with an open gate: PAUSED, lease cleared.
    Final with SKIP/PAUSED/HOLD: unchanged."""
    stage, gate = F.col("stage"), F.col("task_state")
    final = stage == S.FINAL_STAGE
    nxt = next_stage(stage)
    changes = ~final | ~F.coalesce(gate.isin(*S.STICKY_GATES), F.lit(False))
    vals = {
        "stage": F.when(final, stage).otherwise(nxt),
        "status": F.when(final, F.col("status")).otherwise(F.lit("NEW")),
        "task_state": F.when(final | (nxt == S.FINAL_STAGE), F.lit("PAUSED")).otherwise(F.lit("READY")),
        **_cleared_lease(),
        "updated_at": ts(now),
    }
    return changes, vals


def update_where(df: DataFrame, cond: Column, values: dict) -> DataFrame:
    """Set ``values`` on rows where ``cond`` holds (all read the old row)."""
    c = F.coalesce(cond, F.lit(False))
    return df.withColumns({k: F.when(c, v).otherwise(F.col(k)) for k, v in values.items()})


def step(df: DataFrame, now) -> DataFrame:
    """FSM3 on every row of ``df`` (callers gate on READY first, Q30)."""
    changes, vals = step_values(now)
    return update_where(df, changes, vals)


def mark_status(df: DataFrame, status: str, now, note: str | None = None) -> DataFrame:
    """FSM2 on every row of ``df``."""
    return update_where(df, F.lit(True), mark_status_values(status, now, note))


# ---------------------------------------------------------------------------
# Keyed updates (JN7)
# ---------------------------------------------------------------------------

def unique_keys(keys: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """One row per key: repeated keys collapse, and a key that is listed with
    two different payloads raises.  The grouping is on the whole key, so the
    join that follows needs no further exchange of this side."""
    if not payload:
        return keys.select(*PK).distinct()
    values = F.struct(*payload)
    g = keys.groupBy(*PK).agg(F.min(values).alias("_least"), F.max(values).alias("_most"))
    one = F.when(F.col("_least") == F.col("_most"), F.col("_least")).otherwise(F.raise_error(F.concat(
        F.lit("conflicting values for key "), F.coalesce("url", F.lit("NULL")), F.lit(" "),
        F.coalesce(F.col("iteration").cast("string"), F.lit("NULL")))))
    return g.select(*PK, one.alias("_one")).select(*PK, *[F.col("_one")[p].alias(p) for p in payload])


def _join_keys(control: DataFrame, keys: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Control rows with ``_hit`` (and the payload) of the key set; a key listed
    twice still hits its row once."""
    return control.join(unique_keys(keys, payload).withColumn("_hit", F.lit(True)), PK, "left")


def keyed_update(control: DataFrame, keys: DataFrame, cond: Column, values: dict, *,
                 payload: Sequence[str] = ()) -> Updated:
    """Apply ``values`` to control rows whose key is in ``keys`` and ``cond`` holds."""
    cols = control.columns
    j = _join_keys(control, keys, payload)
    hit = F.col("_hit").isNotNull() & F.coalesce(cond, F.lit(False))
    j = j.withColumn("_apply", hit)
    j = j.withColumns({k: F.when(F.col("_apply"), v).otherwise(F.col(k)) for k, v in values.items()})
    return Updated(j.select(*cols), j.where(F.col("_apply")).select(*cols))


def worklist(control: DataFrame, stage: str, statuses=("NEW",), now=None, max_rows: int | None = None,
             columns: Sequence[str] = PK) -> DataFrame:
    """WRK1: claimable (url, iteration) keys (or other ``columns``), oldest first (``created_at`` NULLs
    last, then url, iteration); all of them unless the caller asks for ``max_rows``.

    With a limit Spark plans ``TakeOrderedAndProject``: every partition keeps
    its best ``max_rows`` rows, so the result is a bounded set.  Without one
    the claimable set is returned unsorted (no global sort of the table)."""
    rows = control.where(claimable(stage, statuses, now)).select(*dict.fromkeys((*PK, "created_at", *columns)))
    if not max_rows:
        # the whole claimable set: a set needs no global sort
        return rows.select(*columns)
    rows = rows.orderBy(F.col("created_at").asc_nulls_last(), F.col("url").asc(), F.col("iteration").asc())
    return rows.limit(int(max_rows)).select(*columns)


def claim(control: DataFrame, keys: DataFrame, worker_id: str, now, lease_minutes: int = S.LEASE_DEFAULT_MIN) -> Updated:
    """LSE1: claim keys whose gate is READY and lease free (stage/status not tested, Q3)."""
    values = {
        "is_claimed": F.lit(True),
        "worker_id": F.lit(worker_id),
        "lease_until": lease_expiry(now, lease_minutes),
        "status": F.lit("IN_PROGRESS"),
        "updated_at": ts(now),
    }
    return keyed_update(control, keys, ready_gate() & lease_free(now), values)


def lease_expiry(now, minutes: int) -> Column:
    """DT1: ``now + minutes``."""
    return ts(now) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))


def renew(control: DataFrame, keys: DataFrame, worker_id: str, now, lease_minutes: int = S.LEASE_DEFAULT_MIN) -> Updated:
    """LSE2: extend the lease of rows held (and claimed) by ``worker_id``."""
    cond = (F.col("worker_id") == F.lit(worker_id)) & (F.col("is_claimed") == F.lit(True))
    return keyed_update(control, keys, cond, {"lease_until": lease_expiry(now, lease_minutes),
                                              "updated_at": ts(now)})


def release(control: DataFrame, keys: DataFrame, worker_id: str, now, final_status: str | None = None) -> Updated:
    """LSE3: holder only – clear the lease and set the final status.

    ``final_status`` is one status for all keys, or ``None`` to read it per key
    from the ``final_status`` column of ``keys``."""
    payload = () if final_status is not None else ("final_status",)
    st = F.lit(final_status) if final_status is not None else F.col("final_status")
    values = {**_cleared_lease(), "status": st, "updated_at": ts(now)}
    return keyed_update(control, keys, F.col("worker_id") == F.lit(worker_id), values, payload=payload)


def finalize(control: DataFrame, keys: DataFrame, worker_id: str, now) -> Updated:
    """LSE4: ``keys`` carries ``ok`` and ``notes``.  A non-empty note replaces the
    row's notes whoever holds it (Q15); then the holder's lease is released as
    COMPLETED (ok) or ERROR."""
    cols = control.columns
    if "notes_new" not in keys.columns:
        keys = keys.withColumnRenamed("notes", "notes_new")
    j = _join_keys(control, keys, ("ok", "notes_new"))
    hit = F.col("_hit").isNotNull()
    has_note = hit & F.col("notes_new").isNotNull() & (F.col("notes_new") != "")
    holder = hit & F.coalesce(F.col("worker_id") == F.lit(worker_id), F.lit(False))
    j = j.withColumn("_touched", has_note | holder)
    j = j.withColumns({
        "notes": F.when(has_note, F.coalesce(F.col("notes_new"), F.col("notes"))).otherwise(F.col("notes")),
        "status": F.when(holder, F.when(F.col("ok"), F.lit("COMPLETED")).otherwise(F.lit("ERROR")))
                   .otherwise(F.col("status")),
        "is_claimed": F.when(holder, F.lit(False)).otherwise(F.col("is_claimed")),
        "worker_id": F.when(holder, F.lit(None).cast("string")).otherwise(F.col("worker_id")),
        "lease_until": F.when(holder, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("lease_until")),
        "updated_at": F.when(has_note | holder, ts(now)).otherwise(F.col("updated_at")),
    })
    return Updated(j.select(*cols), j.where(F.col("_touched")).select(*cols))


# ---------------------------------------------------------------------------
# Bulk state transitions
# ---------------------------------------------------------------------------

def advance_completed(control: DataFrame, now) -> Updated:
    """FSM6: each URL's newest row (WIN4) that is COMPLETED and not final moves
    one stage on with status NEW; the gate is only normalised (a DONE landing
    stays READY, Q13); the lease is untouched."""
    latest = newest_by_updated(control).where((F.col("status") == "COMPLETED") & next_stage().isNotNull())
    nxt = next_stage()
    values = {
        "stage": nxt,
        "status": F.lit("NEW"),
        "task_state": normalized_gate(nxt, F.lit("NEW"), F.col("task_state")),
        "updated_at": ts(now),
    }
    return keyed_update(control, latest.select(*PK), F.lit(True), values)


# Fixed value: the note text a retried row carries, verbatim.
RETRY_NOTE = "auto-reset from ERROR by state_sync.retry_error_one"


def retry_errors(control: DataFrame, now) -> Updated:
    """FSM7: each URL's newest row (WIN4) in ERROR goes back to NEW at the same
    stage, with a note; gate normalised."""
    latest = newest_by_updated(control).where(F.col("status") == "ERROR")
    return keyed_update(control, latest.select(*PK), F.lit(True), mark_status_values("NEW", now, RETRY_NOTE))


def advance_all_completed(control: DataFrame, now) -> Updated:
    """FSM8: URLs with a COMPLETED row under the broad active gate (AGG4a); for
    each, its latest READY row (WIN1) is stepped (FSM3).  URLs without a READY
    row are skipped (Q32)."""
    urls = urls_by_filters(control, status=["COMPLETED"], active_only=True)
    # one row per URL first (partial group limit before the shuffle), then the
    # URLs: a hot URL's rows never meet in one task
    targets = latest_state(control, ready_only=True).select(*PK).join(urls, "url", "left_semi")
    changes, vals = step_values(now)
    return keyed_update(control, targets, changes, vals)


def sync_from_registry(url_table: DataFrame, control: DataFrame, now, iteration: int = 0,
                       mode: str = "append") -> DataFrame:
    """SYNC1 (+JN5): one control row per registry URL at ``iteration``.

    ``append``: only keys not yet in control, as URL/NEW/READY.  ``replace``:
    drop control rows of that iteration, then insert all URLs."""
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown sync mode: {mode!r}")
    urls = url_table.select(strip_ws("url").alias("url")).where(F.col("url").isNotNull()).distinct()
    base = control
    if mode == "replace":
        # rows without an iteration are not of that iteration: they stay
        base = control.where(~F.col("iteration").eqNullSafe(F.lit(int(iteration))))
    else:
        existing = control.where(F.col("iteration") == F.lit(int(iteration))).select("url")
        urls = urls.join(existing, "url", "left_anti")
    new_rows = urls.select(
        "url",
        F.lit(int(iteration)).alias("iteration"),
        F.lit("URL").alias("stage"),
        F.lit("NEW").alias("status"),
        F.lit("READY").alias("task_state"),
        F.lit(False).alias("is_claimed"),
        ts(now).alias("created_at"),
    )
    # every new row has a key absent from ``base`` (anti-joined, or its iteration
    # was dropped), so the upsert reduces to an append: no second join
    batch = prepare_batch(new_rows, S.PIPELINE_CONTROL, now)
    return base.select(*S.PIPELINE_CONTROL.columns).unionByName(batch)


def stage_gate(claimed: DataFrame, expected_stage: str) -> tuple[DataFrame, DataFrame]:
    """FLT6: split claimed rows into (at the expected stage, elsewhere)."""
    at = F.coalesce(F.col("stage") == F.lit(expected_stage), F.lit(False))
    return claimed.where(at), claimed.where(~at)


def persist_states(control: DataFrame, states: DataFrame, now) -> DataFrame:
    """FSM5: persist state rows – gate normalised (FSM4), then upserted by key (UPS1)."""
    s = states.withColumn("task_state", normalized_gate(F.col("stage"), F.col("status"), F.col("task_state")))
    return upsert(control, s, S.PIPELINE_CONTROL, now)
