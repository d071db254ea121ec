"""Stage runners (RUN1–RUN4) as set operations over the control table.

The reference walks a worklist URL by URL (claim, work, release, mark,
step).  Here a runner lists the worklist, claims it, does the stage's work
for the whole claimed set, and applies every key's outcome in one keyed
update; the intermediate per-row states are not observable afterwards
(§2.9.1), only the end state and the counters.

Single writer: the listing and the claim read the same table version unless
the caller passes another version to claim against (``claim_view``) – that is
how a competing worker's lease is modelled."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.functions.text import prepend_note
from tablerail.operators.control import PK, _join_keys, worklist
from tablerail.operators.predicates import claimable, include_urls, lease_free, ready_gate
from tablerail.session import ts

# Fixed value: the note text of a row the URL runner moved on, verbatim.
URL_DONE_NOTE = "URL stage done"


def run_counters() -> list[Column]:
    """AGG9 over the flags of ``outcome_rows``, for the write that carries them."""
    hit, claimed, at, ok = (F.col(c) for c in ("_hit", "_claimed", "_at", "_okrow"))
    return [F.count_if(hit.isNotNull()).alias("found"), F.count_if(claimed).alias("claimed"),
            F.count_if(claimed & at & ok).alias("completed"), F.count_if(claimed & ok).alias("enqueued_next")]


@dataclass
class StageRun:
    """Outcome of one runner pass."""

    control: DataFrame        # next version of the control table
    outcomes: DataFrame       # one row per listed key: url, iteration, claimed, ok, final stage/status
    extra: dict               # stage outputs (web_page / web_summary tables)
    # control rows → the same rows after the run, with the flags RUN_COUNTERS counts
    apply: Callable[[DataFrame], DataFrame] | None = None

    def counters(self) -> DataFrame:
        """AGG9: found / claimed / completed / enqueued_next as one row."""
        o = self.outcomes
        return o.agg(
            F.count(F.lit(1)).alias("found"),
            F.count_if(F.col("claimed")).alias("claimed"),
            # completed: the stage's work succeeded, not merely that it was tried
            F.count_if(F.col("claimed") & F.col("at_stage") & F.col("ok")).alias("completed"),
            F.count_if(F.col("claimed") & F.col("ok")).alias("enqueued_next"),
        )


@dataclass(frozen=True)
class Listing:
    """What a runner listed: a condition on control rows (the whole claimable
    set, decided in the pass that updates them) or, where a limit, an include
    list or another table version needs it, an explicit key set.

    ``queue``: rows of the same version to take the work from, where these are
    kept apart from the control table (their state columns and keys suffice)."""

    condition: Column | None = None
    keys: DataFrame | None = None
    queue: DataFrame | None = None

    def hit(self, control: DataFrame) -> DataFrame:
        """``control`` with ``_hit`` where a row is listed."""
        if self.keys is not None:
            return _join_keys(control, self.keys)
        return control.withColumn("_hit", F.when(F.coalesce(self.condition, F.lit(False)), F.lit(True)))


def list_claimable(control: DataFrame, stage: str, statuses: list[str], now, max_rows: int | None = None,
                   filter_urls: DataFrame | None = None, own_version: bool = True) -> Listing:
    """WRK1 for a runner: every claimable row, or at most ``max_rows`` (the limit
    holds before the URL include list, Q5)."""
    if not max_rows and filter_urls is None and own_version:
        return Listing(condition=claimable(stage, statuses, now))
    return Listing(keys=include_urls(worklist(control, stage, statuses, now, max_rows=max_rows), filter_urls))


def outcome_rows(control: DataFrame, listed: Listing, now, stage: str, work_ok: DataFrame | None, ok_values: dict,
                 fail_values: dict) -> DataFrame:
    """Claim the listed rows of ``control`` and apply each claimed key's end state.

    ``work_ok`` is (url, iteration, ok) for keys whose work ran; claimed keys
    at ``stage`` without a row count as failed.  Every row of ``control`` is there
    after it, with the flags _hit (listed), _claimed, _at (at ``stage``), _okrow."""
    j = listed.hit(control)
    if work_ok is not None:
        j = j.join(work_ok.select(*PK, F.col("ok").alias("_ok")), PK, "left")
    else:
        j = j.withColumn("_ok", F.lit(True))
    hit = F.col("_hit").isNotNull()
    claimed = hit & F.coalesce(ready_gate() & lease_free(now), F.lit(False))
    at_stage = F.coalesce(F.col("stage") == F.lit(stage), F.lit(False))
    j = j.withColumns({"_claimed": claimed, "_at": at_stage})
    ok = F.col("_claimed") & F.col("_at") & F.coalesce(F.col("_ok"), F.lit(False))
    fail = F.col("_claimed") & ~ok
    j = j.withColumn("_okrow", ok)
    new_vals = {}
    released = _released()
    for c in set(ok_values) | set(fail_values) | {"is_claimed", "worker_id", "lease_until", "updated_at"}:
        okv = ok_values.get(c, released.get(c, F.col(c)))
        fv = fail_values.get(c, released.get(c, F.col(c)))
        if c == "updated_at":
            okv = fv = ts(now)
        new_vals[c] = F.when(F.col("_okrow"), okv).when(fail, fv).otherwise(F.col(c))
    return j.withColumns(new_vals)


def claim_outcome(control: DataFrame, listed: Listing, out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new control, outcomes) of ``outcome_rows`` over the whole ``control``."""
    outcomes = out.where(F.col("_hit").isNotNull()).select(
        *PK, F.col("_claimed").alias("claimed"), F.col("_at").alias("at_stage"), F.col("_okrow").alias("ok"),
        F.col("stage").alias("final_stage"), F.col("status").alias("final_status"))
    if listed.keys is not None:
        # keys listed but gone from the table count as found, not claimed
        gone = listed.keys.select(*PK).join(control.select(*PK), PK, "left_anti")
        outcomes = outcomes.unionByName(gone.select(
            *PK, F.lit(False).alias("claimed"), F.lit(False).alias("at_stage"), F.lit(False).alias("ok"),
            F.lit(None).cast("string").alias("final_stage"), F.lit(None).cast("string").alias("final_status")))
    return out.select(*control.columns), outcomes


def stage_run(control: DataFrame, listed: Listing, now, stage: str, work_ok: DataFrame | None, ok_values: dict,
              fail_values: dict, extra: dict) -> StageRun:
    """A run's result for the whole table, and as a change to any part of it."""
    def apply(rows: DataFrame) -> DataFrame:
        return outcome_rows(rows, listed, now, stage, work_ok, ok_values, fail_values)
    return StageRun(*claim_outcome(control, listed, apply(control)), extra, apply)


def _released() -> dict:
    return {"is_claimed": F.lit(False), "worker_id": F.lit(None).cast("string"),
            "lease_until": F.lit(None).cast("timestamp_ntz")}


def run_url_stage(control: DataFrame, now, worker_id: str, max_batch: int | None = None,
                  claim_view: DataFrame | None = None, listed: Listing | None = None) -> StageRun:
    """RUN1: URL → WEB_PAGE for claimable URL/NEW rows; all of them unless
    ``max_batch`` is given.  Without a limit this is one narrow pass, no shuffle.

    ok: WEB_PAGE / NEW / READY, lease cleared, note ``[ts] URL stage done``;
    claimed but not at URL: ERROR, lease cleared."""
    listed = listed or list_claimable(control, "URL", ["NEW"], now, max_batch, own_version=claim_view is None)
    target = control if claim_view is None else claim_view
    ok_values = {"stage": F.lit("WEB_PAGE"), "status": F.lit("NEW"), "task_state": F.lit("READY"),
                 "notes": prepend_note("notes", ts(now), URL_DONE_NOTE)}
    fail_values = {"status": F.lit("ERROR")}
    return stage_run(target, listed, now, "URL", None, ok_values, fail_values, {})


def claimed_keys(control: DataFrame, listed: Listing | DataFrame, now, stage: str) -> DataFrame:
    """Keys of the listing that a claim would take and that sit at ``stage`` (the work set)."""
    if isinstance(listed, DataFrame):
        listed = Listing(keys=listed)
    return listed.hit(control if listed.queue is None else listed.queue).where(
        F.col("_hit").isNotNull() & ready_gate() & lease_free(now) & (F.col("stage") == stage)).select(*PK)


def stage_listing(control: DataFrame, stage: str, now, max_rows: int | None, retry_errors: bool,
                  filter_urls: DataFrame | None) -> Listing:
    """Listing of a work stage: NEW (plus ERROR, IN_PROGRESS when retrying)."""
    return list_claimable(control, stage, listed_statuses(retry_errors), now, max_rows, filter_urls)


def listed_statuses(retry_errors: bool) -> list[str]:
    return ["NEW", "ERROR", "IN_PROGRESS"] if retry_errors else ["NEW"]
