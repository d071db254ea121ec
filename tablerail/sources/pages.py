"""Page fetch (SRC8) and fetched-page rows (SNK1, STR1, STR2).

A fetcher turns a key DataFrame ``(url, iteration)`` into
``(url, iteration, status_code, html, error)``.  Two are provided:

* ``TableFetcher``: pages already crawled into a table (``url``, ``html``) –
  a keyed join, no Python; used by tests and by re-processing runs;
* ``HttpFetcher``: plain HTTP GET per URL inside ``mapInPandas`` (one
  partition per concurrent fetch slot), failures captured per row.

Neither renders JavaScript: visible text comes from fixed text rules (STR2)."""

from __future__ import annotations

import heapq
import time
import urllib.request
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.functions.text import clean_page_text, has_visible_text, with_page_text
from tablerail.session import ts

FETCH_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("iteration", T.IntegerType()),
    T.StructField("status_code", T.IntegerType()), T.StructField("html", T.StringType()),
    T.StructField("error", T.StringType()),
])


class TableFetcher:
    """Fetch = look the URL up in a table of crawled pages.

    A URL crawled more than once counts once: the page with the greatest
    ``version`` column if one is named, else the greatest html text (so the
    choice depends on the data alone)."""

    # A batch of so many keys is sent to all tasks, and only its pages are shuffled.
    FEW_KEYS = 100_000

    def __init__(self, pages: DataFrame, url_col: str = "url", html_col: str = "html", version_col: str | None = None):
        rank = F.struct(*([F.col(version_col)] if version_col else []), F.col(html_col).alias("html"))
        self.crawl = pages.select(F.col(url_col).alias("url"), rank.alias("_page"))

    def pages_of(self, keys: DataFrame) -> DataFrame:
        """(url, html): the pages of the keys' URLs; of all URLs if the keys are many."""
        crawl = self.crawl
        if keys.limit(self.FEW_KEYS + 1).count() <= self.FEW_KEYS:
            crawl = crawl.join(F.broadcast(keys.select("url").distinct()), "url", "left_semi")
        # partial maxima before the shuffle: a URL crawled very often is no hot task
        return crawl.groupBy("url").agg(F.max("_page").alias("_best")).select("url", F.col("_best.html").alias("html"))

    def fetch(self, keys: DataFrame) -> DataFrame:
        k = keys.select("url", "iteration")
        pages = self.pages_of(k)
        # The key set is narrow but every key expands into a page to clean.
        # Hash it on the whole key into the shuffle width, so the cleaning
        # that follows never runs in the one task AQE would coalesce a
        # small key set into, and a URL with many iterations is spread: a
        # broadcast page table keeps this partitioning; a large one gets a
        # sort-merge join on url whose own shuffle AQE may split for skew.
        n = int(k.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        k = k.repartition(n, "url", "iteration")
        j = k.join(pages, "url", "left")
        return j.select("url", "iteration",
                        F.when(F.col("html").isNotNull(), F.lit(200)).cast("int").alias("status_code"),
                        "html", F.when(F.col("html").isNull(), F.lit("not found")).alias("error"))


def url_host(url: str) -> Column:
    """The host of a URL column in lower case; what has none shares the empty host."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


class HostPace:
    """The next allowed start of a request by lane (a host's stripe), within a task."""

    def __init__(self, interval_s: float):
        self.interval_s, self.due = interval_s, {}

    def in_turn(self, lanes: list) -> Iterator[int]:
        """Positions of ``lanes`` in the order to fetch them: whichever lane may go
        soonest is next, in its own order, and only if none may go is there a wait."""
        waiting: dict = {}
        for i, lane in enumerate(lanes):
            waiting.setdefault(lane, deque()).append(i)
        now = time.monotonic()
        self.due = {lane: at for lane, at in self.due.items() if at > now}  # the past binds nothing
        ready = [(self.due.get(lane, now), i[0], lane) for lane, i in waiting.items()]
        heapq.heapify(ready)
        while ready:
            at, _, lane = heapq.heappop(ready)
            time.sleep(max(0.0, at - time.monotonic()))
            self.due[lane] = time.monotonic() + self.interval_s
            queue = waiting[lane]
            yield queue.popleft()
            if queue:
                heapq.heappush(ready, (self.due[lane], queue[0], lane))


class HttpFetcher:
    """HTTP GET per URL on executors.

    The keys are dealt over ``partitions`` tasks (default: the shuffle width);
    how many run at a time, and so fetch in parallel, is the cluster's number of
    cores.

    ``per_host``: requests a second that one host gets at most, over the whole
    cluster.  A host's keys are then dealt over ``stripes`` lanes, each in one task
    and with an equal part of the host's pace, so that a host with a third of all
    keys is no single task's work; a task takes its lanes in turn and waits only if
    none of them may go on.  A rate below one a second is kept in one lane.

      Bodies are passed on every ``YIELD_ROWS`` pages, so few wait in
    memory.  ``open_url(request, timeout)`` can be replaced (tests)."""

    YIELD_ROWS = 32

    def __init__(self, partitions: int | None = None, timeout_s: float = 8.0, user_agent: str = "tablerail/0.1",
                 open_url=None, per_host: float | None = None, stripes: int = 8):
        self.partitions, self.timeout_s, self.user_agent = partitions, timeout_s, user_agent
        self.open_url = open_url
        if per_host is not None and per_host <= 0:
            raise ValueError("per_host is a number of requests above 0")
        self.per_host, self.stripes = per_host, max(1, min(stripes, int(per_host or 0)))

    def lane_interval(self) -> float:
        """Seconds between the starts of two requests of a lane: all lanes of a host
        together start at most ``per_host`` in any second."""
        return 1 / self.per_host if self.stripes == 1 else 1 / (self.per_host // self.stripes)

    def _run(self):
        timeout, agent, open_url, rows = self.timeout_s, self.user_agent, self.open_url or _open, self.YIELD_ROWS
        pace_s = self.lane_interval() if self.per_host else None

        def paced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """Rows one by one as their lane's turn comes (a batch of narrow rows waits in memory)."""
            pace = HostPace(pace_s)
            for b in batches:
                for i in pace.in_turn(b["_lane"].tolist()):
                    yield b.iloc[i:i + 1]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in paced(batches) if pace_s else (b.iloc[k:k + rows] for b in batches for k in range(0, len(b), rows)):
                codes, bodies, errors = [], [], []
                for url in pdf["url"].tolist():
                    try:
                        req = urllib.request.Request(url, headers={"User-Agent": agent})
                        with open_url(req, timeout) as r:
                            raw = r.read()
                            charset = r.headers.get_content_charset() or "utf-8"
                            codes.append(int(r.status))
                            bodies.append(raw.decode(charset, errors="replace"))
                            errors.append(None)
                    except Exception as e:  # noqa: BLE001 - per-row failure
                        codes.append(getattr(e, "code", None))
                        bodies.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                yield pd.DataFrame({"url": pdf["url"], "iteration": pdf["iteration"], "status_code": codes,
                                    "html": bodies, "error": errors})
        return run

    def fetch(self, keys: DataFrame) -> DataFrame:
        n = self.partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        src = keys.select("url", "iteration")
        if not self.per_host:
            return src.repartition(n, "url", "iteration").mapInPandas(self._run(), FETCH_SCHEMA)
        stripe = F.pmod(F.xxhash64("url", "iteration"), F.lit(self.stripes))
        # every key of a lane in one task; a hashed order, so that lanes alternate
        src = (src.withColumn("_lane", F.concat_ws("/", url_host("url"), stripe)).repartition(n, "_lane")
               .sortWithinPartitions(F.xxhash64(F.lit(1), "url", "iteration")))
        return src.mapInPandas(self._run(), FETCH_SCHEMA)


def _open(request, timeout: float):
    return urllib.request.urlopen(request, timeout=timeout)  # noqa: S310 - user-supplied crawl list


def fetch_pages(keys: DataFrame, fetcher) -> DataFrame:
    """SRC8: fetch the pages of ``keys`` with a pluggable fetcher."""
    return fetcher.fetch(keys)


def page_rows(fetched: DataFrame, now, keep_html: bool = False) -> DataFrame:
    """SNK1: fetched pages → ``web_page`` rows plus ``ok``.

    Success is decided on the visible text before cleaning (Q33): a page whose
    text is only URLs still counts as fetched with an empty ``clean_text``.
    A failed or empty fetch gives one ``FETCH_FAILED`` row (Q29)."""
    staged = with_page_text(fetched, "html", "_text")
    ok = F.col("html").isNotNull() & F.col("error").isNull() & has_visible_text(F.col("_text"))
    return staged.select(
        "url", "iteration",
        F.lit(None).cast("int").alias("status_code"),
        (F.col("html") if keep_html else F.lit(None).cast("string")).alias("html"),
        F.when(ok, clean_page_text(F.col("_text"))).alias("clean_text"),
        ts(now).alias("fetched_at"),
        F.when(~ok, F.lit(S.FETCH_FAILED)).alias("fetch_error"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        ok.alias("ok"),
    )
