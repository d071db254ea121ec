"""The pipeline over stored tables: each command reads the current version of
the tables it needs, runs the set-based operators and writes the buckets that
changed (the runner's unit of work is a stage over the whole claimed set).

This is what the reference's command line does (``scrape``, ``summarize``,
``all``, ``advance-completed``), on versioned parquet tables instead of one
database file."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators.control import PK, advance_all_completed, claim, sync_from_registry, worklist
from tablerail.operators.inference import InferenceParams, forget_answers
from tablerail.operators.predicates import claimable, include_urls
from tablerail.plans.runs import Listing, listed_statuses, run_counters, run_url_stage
from tablerail.operators.upsert import upsert
from tablerail.plans.stages import run_page_stage, run_summary_stage
from tablerail.session import ts, utc_now_str
from tablerail.sources.seeds import ingest_seed_files
from tablerail.sources.store import TableStore, materialize, release_materialized


@dataclass
class Pipeline:
    spark: SparkSession
    root: str
    scratch_dir: str | None = None
    now: str | None = None              # fixed clock (tests); default: UTC now per command
    worker_prefix: str = "runner"
    bucket_rows: int | None = None      # rows from which a bucket of a table splits
    store: TableStore = field(init=False)

    def __post_init__(self):
        self.store = TableStore(self.spark, self.root, self.bucket_rows)
        # side-effect results (fetches, model responses) go next to the tables: a shared folder
        if self.scratch_dir is None:
            self.scratch_dir = f"{self.root.rstrip('/')}/_scratch"

    def _now(self) -> str:
        return self.now or utc_now_str()

    # -- tables ---------------------------------------------------------------
    def bootstrap(self) -> dict[str, bool]:
        """SNK4: create the four tables if missing (idempotent)."""
        return self.store.bootstrap()

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    # -- commands -------------------------------------------------------------
    def ingest(self, seed_paths) -> int:
        """SRC3: seed files → registry upsert; returns the version written."""
        empty = self.spark.createDataFrame([], S.URL.schema)
        return self.register_urls(ingest_seed_files(self.spark, seed_paths, empty, self._now()))

    def register_urls(self, rows: DataFrame) -> int:
        """Upsert registry rows produced by Spark (``url``, ``source``, ``tags``)."""
        now = self._now()
        return self.store.upsert("url", rows, lambda old, batch: upsert(old, batch, S.URL, now))

    def sync(self, iteration: int = 0, mode: str = "append") -> int:
        """SYNC1: registry → control rows at URL/NEW/READY.  Appending writes the
        buckets of the new rows only."""
        control = self.table("pipeline_control")
        out = sync_from_registry(self.table("url"), control, self._now(), iteration, mode)
        if mode == "replace":
            return self.store.write("pipeline_control", out)
        new = materialize(out.join(control.select(*PK), list(PK), "left_anti"))
        version = self.store.upsert("pipeline_control", new, lambda old, rows: old.unionByName(rows))
        release_materialized(self.spark)
        return version

    def worklist(self, stage: str, statuses=("NEW",), max_rows: int | None = None, now: str | None = None) -> DataFrame:
        """WRK1 from the queue kept beside control: the claimable rows (state and
        key), or the oldest ``max_rows``, written once.

        With a limit the queue is read up to a point of its order that should hold
        enough rows, and further only if leases leave too few of them."""
        now, kinds = now or self._now(), [(stage, s) for s in statuses]
        queue = self.store.queue("pipeline_control", kinds)
        if not max_rows:
            return queue.where(claimable(stage, statuses, now))
        for bound in self.store.head_bounds("pipeline_control", kinds, max_rows):
            head = queue if bound is None else queue.where(F.col("created_at") <= ts(bound))
            found = materialize(worklist(head, stage, statuses, now, max_rows, head.columns), self.scratch_dir)
            if bound is None or found.count() == max_rows:
                return found
        raise AssertionError("the last bound is None")

    def _listing(self, stage: str, statuses, max_rows: int | None, filter_urls: DataFrame | None, now: str) -> Listing:
        """What a runner works on, without a read of the control table (the limit
        holds before the URL include list, Q5).  A command uses one clock reading: a
        lease that ends while it runs is not taken."""
        rows = self.worklist(stage, statuses, max_rows, now)
        if not max_rows and filter_urls is None:
            return Listing(condition=claimable(stage, statuses, now), queue=rows)
        rows = include_urls(rows, filter_urls)
        return Listing(keys=rows.select(*PK), queue=rows)

    def claim(self, worker_id: str, stage: str, statuses=("NEW",), max_rows: int | None = None,
              lease_minutes: int = S.LEASE_DEFAULT_MIN) -> DataFrame:
        """LSE1 on the stored table: lease the claimable rows (the oldest ``max_rows``)
        to a worker; returns their keys.  Reads the queue's head and the buckets of
        these keys."""
        now = self._now()
        rows = self.worklist(stage, statuses, max_rows, now)
        keys = (rows if max_rows else materialize(rows, self.scratch_dir)).select(*PK)
        self.store.revise("pipeline_control", self.store.touched("pipeline_control", keys),
                          lambda old: claim(old, keys, worker_id, now, lease_minutes).control)
        return keys

    def run_urls(self, max_batch: int | None = None) -> dict:
        """RUN1 (+AGG9 counters)."""
        now = self._now()
        listed = self._listing("URL", ["NEW"], max_batch, None, now)
        return self._store_run(run_url_stage(self.table("pipeline_control"), now, f"{self.worker_prefix}-urls", listed=listed), listed)

    def _store_run(self, run, listed: Listing) -> dict:
        """Write the buckets of the listed rows as the run leaves them, and count its
        outcomes (AGG9) in that same pass; then drop its intermediate folders."""
        hit = self.store.touched("pipeline_control", listed.queue.select(*PK))
        found = self.store.revise("pipeline_control", hit, run.apply, run_counters())
        release_materialized(self.spark)
        return found or dict.fromkeys(("found", "claimed", "completed", "enqueued_next"), 0)

    def scrape(self, fetcher, max_rows: int | None = None, retry_errors: bool = False,
               filter_urls: DataFrame | None = None) -> dict:
        """RUN2: WEB_PAGE → WEB_SUMMARY for every claimable row, or at most ``max_rows``."""
        now = self._now()
        listed = self._listing("WEB_PAGE", listed_statuses(retry_errors), max_rows, filter_urls, now)
        run = run_page_stage(self.table("pipeline_control"), self.table("web_page"), fetcher, now,
                             f"{self.worker_prefix}-pages", scratch_dir=self.scratch_dir, listed=listed)
        self.store.upsert("web_page", run.extra["fetched"].drop("ok"), lambda old, rows: upsert(old, rows, S.WEB_PAGE, now))
        return self._store_run(run, listed)

    def summarize(self, client_factory, params: InferenceParams | None = None, max_rows: int | None = None,
                  retry_errors: bool = False, filter_urls: DataFrame | None = None) -> dict:
        """RUN3: WEB_SUMMARY → DONE for every claimable row, or at most ``max_rows``."""
        answers = f"{self.root.rstrip('/')}/_answers"
        now = self._now()
        listed = self._listing("WEB_SUMMARY", listed_statuses(retry_errors), max_rows, filter_urls, now)
        run = run_summary_stage(self.table("pipeline_control"), self.table("web_page"), self.table("web_summary"),
                                client_factory, params or InferenceParams(), now, f"{self.worker_prefix}-summaries",
                                scratch_dir=self.scratch_dir, answers=answers, listed=listed)
        self.store.upsert("web_summary", run.extra["good"], lambda old, rows: upsert(old, rows, S.WEB_SUMMARY, now))
        counters = self._store_run(run, listed)
        forget_answers(self.spark, answers)
        return counters

    def advance_completed(self) -> int:
        """FSM8: step every URL with a COMPLETED row (latest READY row)."""
        out = advance_all_completed(self.table("pipeline_control"), self._now())
        return self.store.replace_rows("pipeline_control", out.control, out.rows)

    def run_all(self, seed_paths=None, fetcher=None, client_factory=None, params: InferenceParams | None = None,
                max_scrape: int | None = None, max_summarize: int | None = None, retry_errors: bool = False) -> dict:
        """RUN4: bootstrap, ingest, sync, URL runner, page stage, summary stage; all rows
        unless a limit is given.  The summary stage needs a model client."""
        if client_factory is None:
            raise ValueError("a full run needs a model client")
        self.bootstrap()
        if seed_paths:
            self.ingest(seed_paths)
        self.sync()
        out = {"urls": self.run_urls()}
        if fetcher is not None:
            out["pages"] = self.scrape(fetcher, max_scrape, retry_errors)
        out["summaries"] = self.summarize(client_factory, params, max_summarize, retry_errors)
        return out

    def progress(self) -> DataFrame:
        """AGG1 of the current control table, from the counts kept with its buckets:
        no data is read."""
        return self.spark.createDataFrame(self.store.counts("pipeline_control"), "stage string, status string, count long")

    def status(self, urls: DataFrame) -> DataFrame:
        """SRC6: the control rows of the given URLs (column ``url``); only the buckets
        they can be in are opened."""
        return self.store.lookup("pipeline_control", urls)
