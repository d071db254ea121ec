"""Work stages (RUN2 page fetch, RUN3 summarise, RUN4 full run)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.functions.prompts import SUMMARIZE_JSON_TEMPLATE, render
from tablerail.operators.control import PK, sync_from_registry
from tablerail.operators.inference import (RAW_RESPONSE_COLUMNS, InferenceParams, check_provider, infer,
                                           infer_stored, summary_rows)
from tablerail.operators.predicates import has_text
from tablerail.operators.queries import newest_page
from tablerail.operators.upsert import upsert
from tablerail.plans.runs import Listing, StageRun, claimed_keys, run_url_stage, stage_listing, stage_run
from tablerail.sources.pages import fetch_pages, page_rows
from tablerail.sources.store import materialize


def run_page_stage(control: DataFrame, web_page: DataFrame, fetcher, now, worker_id: str, *,
                   max_rows: int | None = None, filter_urls: DataFrame | None = None, retry_errors: bool = False,
                   keep_html: bool = False, scratch_dir: str | None = None, listed: Listing | None = None) -> StageRun:
    """RUN2 (WEB_PAGE → WEB_SUMMARY): list, claim, fetch, clean, store pages,
    then per key: ok → WEB_SUMMARY/NEW/READY, fetch failed or wrong stage → ERROR.

    Every claimable row is processed unless ``max_rows`` is given; ``listed``: a
    listing made elsewhere (from a stored table's queue)."""
    listed = listed or stage_listing(control, "WEB_PAGE", now, max_rows, retry_errors, filter_urls)
    work = claimed_keys(control, listed, now, "WEB_PAGE")
    # fetching has side effects: persist before anything branches on it
    pages = materialize(page_rows(fetch_pages(work, fetcher), now, keep_html), scratch_dir)
    new_pages = upsert(web_page, pages.drop("ok"), S.WEB_PAGE, now)
    ok_values = {"stage": F.lit("WEB_SUMMARY"), "status": F.lit("NEW"), "task_state": F.lit("READY")}
    fail_values = {"status": F.lit("ERROR")}
    return stage_run(control, listed, now, "WEB_PAGE", pages.select(*PK, "ok"), ok_values, fail_values,
                     {"web_page": new_pages, "fetched": pages})


def claimed_pages(work: DataFrame, web_page: DataFrame) -> DataFrame:
    """JN6: each claimed key with its newest ``web_page`` row (WIN2); keys
    without a page get ``page_found = false`` (they end as ERROR).  Only the
    narrow page columns are read."""
    pages = web_page.select("url", "iteration", "clean_text", "created_at", "updated_at", "fetched_at") \
        .join(work.select(*PK), PK, "left_semi")
    newest = newest_page(pages).select(*PK, "clean_text", F.col("created_at").alias("page_created_at"),
                                       F.lit(True).alias("page_found"))
    return work.select(*PK).join(newest, PK, "left").withColumn(
        "page_found", F.coalesce(F.col("page_found"), F.lit(False)))


def run_summary_stage(control: DataFrame, web_page: DataFrame, web_summary: DataFrame, client_factory,
                      params: InferenceParams, now, worker_id: str, *, max_rows: int | None = None,
                      filter_urls: DataFrame | None = None, retry_errors: bool = False,
                      scratch_dir: str | None = None, answers: str | None = None, listed: Listing | None = None) -> StageRun:
    """RUN3 (WEB_SUMMARY → DONE): list, claim, join the newest page row (JN6),
    reject blank text (FLT2), prompt (STR6), call the model (LLM2/3), validate
    (LLM4–6), derive text (STR7), store summaries (LLM8); per key: ok →
    DONE/NEW/PAUSED, anything else → ERROR.  Every claimable row is processed
    unless ``max_rows`` is given.  ``answers``: a folder where answers are logged as
    tasks end, so that a run that died repeats no logged call; the caller forgets
    it when the results are stored."""
    check_provider(params.provider)
    listed = listed or stage_listing(control, "WEB_SUMMARY", now, max_rows, retry_errors, filter_urls)
    work = claimed_keys(control, listed, now, "WEB_SUMMARY")
    page = claimed_pages(work, web_page)
    ready = page.where(F.col("page_found") & has_text("clean_text")).select(*PK, "clean_text")
    # the cleaned text is dealt out; the template is filled in after that shuffle
    prompt = render(SUMMARIZE_JSON_TEMPLATE, url=F.col("url"), content=F.col("clean_text"))
    # model calls cost money: persist the validated responses before branching,
    # so neither branch (summary table, control update) repeats a call or the
    # JSON checks
    if answers:
        said = infer_stored(ready, prompt, client_factory, params, answers)
    else:
        said = infer(ready, prompt, client_factory, params)
    checked = materialize(summary_rows(said, params, now, keep_raw=True), scratch_dir)
    rows = checked.drop(*RAW_RESPONSE_COLUMNS)
    responses = checked.select(*PK, *RAW_RESPONSE_COLUMNS)
    good = rows.where(F.col("error").isNull()).drop("error")
    new_summary = upsert(web_summary, good, S.WEB_SUMMARY, now)
    ok = rows.select(*PK, F.col("error").isNull().alias("ok"))
    ok_values = {"stage": F.lit("DONE"), "status": F.lit("NEW"), "task_state": F.lit("PAUSED")}
    fail_values = {"status": F.lit("ERROR")}
    return stage_run(control, listed, now, "WEB_SUMMARY", ok, ok_values, fail_values,
                     {"web_summary": new_summary, "responses": responses, "checked": rows, "good": good})


@dataclass
class FullRun:
    url: DataFrame
    control: DataFrame
    web_page: DataFrame
    web_summary: DataFrame
    runs: dict


def run_all(registry_rows: DataFrame, fetcher, now, *, url_table: DataFrame | None = None,
            control: DataFrame | None = None, web_page: DataFrame | None = None,
            web_summary: DataFrame | None = None, client_factory=None,
            params: InferenceParams | None = None, max_rows: int | None = None, append_only_urls: bool = True,
            worker_prefix: str = "run", scratch_dir: str | None = None, answers: str | None = None) -> FullRun:
    """RUN4: ingest registry rows, sync control, then URL → page → summary; all
    rows unless ``max_rows`` limits each stage's batch.  A model client is required;
    it is asked only what the log in the folder ``answers`` does not hold.

    Every table version is materialised before the next stage reads it, so a
    lost executor only recomputes the current stage."""
    if client_factory is None:
        raise ValueError("a full run needs a model client")
    spark = registry_rows.sparkSession
    params = params or InferenceParams()

    def empty(spec):
        return spark.createDataFrame([], spec.schema)

    url_table = url_table if url_table is not None else empty(S.URL)
    control = control if control is not None else empty(S.PIPELINE_CONTROL)
    web_page = web_page if web_page is not None else empty(S.WEB_PAGE)
    web_summary = web_summary if web_summary is not None else empty(S.WEB_SUMMARY)

    url_table = materialize(upsert(url_table, registry_rows, S.URL, now), scratch_dir)
    control = materialize(sync_from_registry(url_table, control, now,
                                             mode="append" if append_only_urls else "replace"), scratch_dir)
    r1 = run_url_stage(control, now, f"{worker_prefix}-urls")
    control = materialize(r1.control, scratch_dir)
    r2 = run_page_stage(control, web_page, fetcher, now, f"{worker_prefix}-pages", max_rows=max_rows,
                        scratch_dir=scratch_dir)
    control = materialize(r2.control, scratch_dir)
    web_page = materialize(r2.extra["web_page"], scratch_dir)
    r3 = run_summary_stage(control, web_page, web_summary, client_factory, params, now, f"{worker_prefix}-summaries",
                           max_rows=max_rows, scratch_dir=scratch_dir, answers=answers)
    control = materialize(r3.control, scratch_dir)
    web_summary = materialize(r3.extra["web_summary"], scratch_dir)
    return FullRun(url_table, control, web_page, web_summary, {"urls": r1, "pages": r2, "summaries": r3})
