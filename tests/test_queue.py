"""The queue kept beside stored control, claims from its head, counters of a write."""
import datetime as dt
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators import control as C
from tablerail.plans.pipeline import Pipeline
from tablerail.session import TEST_NOW
from tablerail.sources.pages import TableFetcher
from tablerail.sources.store import TableStore

# workers cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])
NOW = dt.datetime.fromisoformat(TEST_NOW)


def _rows(spark, n, seed=1, stages=("URL", "WEB_PAGE")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lease = rng.choice([None, NOW - dt.timedelta(hours=1), NOW + dt.timedelta(hours=1)])
        made = rng.choice([None, *[NOW - dt.timedelta(minutes=rng.randrange(n)) for _ in range(5)]])
        out.append((f"u{i % (n // 2)}", i // (n // 2), rng.choice(stages), rng.choice(["NEW", "ERROR", None]),
                    rng.choice(["READY", "READY", "HOLD", None]), lease is not None, "w" if lease else None, lease, None, None, made, made))
    return spark.createDataFrame(out, S.PIPELINE_CONTROL.schema)


def _key_list(df):
    return sorted((r.url, r.iteration) for r in df.select("url", "iteration").collect())


def test_worklists_from_the_queue_equal_those_from_the_table(spark, scratch):
    """Limited and not, one status and several, with leases in the way, ties and null dates."""
    pipe = Pipeline(spark, os.path.join(scratch, "t"), now=TEST_NOW, bucket_rows=60)
    pipe.store.write("pipeline_control", _rows(spark, 600))
    control = pipe.table("pipeline_control")
    assert len(pipe.store.buckets("pipeline_control")) >= 10
    for statuses in (["NEW"], ["NEW", "ERROR"], ["DONE"]):
        for n in (None, 1, 7, 60, 10_000):
            assert _key_list(pipe.worklist("WEB_PAGE", statuses, n)) == _key_list(C.worklist(control, "WEB_PAGE", statuses, TEST_NOW, n)), (statuses, n)


def test_leases_over_the_whole_head_lead_on(spark, scratch):
    """The oldest rows are all leased: the read goes on behind them."""
    pipe = Pipeline(spark, os.path.join(scratch, "t"), now=TEST_NOW, bucket_rows=100)
    rows = _rows(spark, 400).withColumns({"task_state": F.lit("READY"), "status": F.lit("NEW"), "stage": F.lit("URL"),
                                          "created_at": F.lit(NOW) + F.make_dt_interval(mins=F.substring("url", 2, 9).cast("int"))})
    late = F.substring("url", 2, 9).cast("int") >= 190
    rows = rows.withColumns({"is_claimed": ~late, "lease_until": F.when(~late, F.lit(NOW) + F.make_dt_interval(hours=F.lit(1)))})
    pipe.store.write("pipeline_control", rows)
    bounds = pipe.store.head_bounds("pipeline_control", [("URL", "NEW")], 5)
    assert len(bounds) > 1 and bounds[-1] is None and bounds[:-1] == sorted(bounds[:-1])
    assert _key_list(pipe.worklist("URL", ["NEW"], 5)) == _key_list(C.worklist(rows, "URL", ["NEW"], TEST_NOW, 5))


def test_a_limited_claim_opens_the_head_and_the_touched_buckets(spark, scratch, monkeypatch):
    pipe = Pipeline(spark, os.path.join(scratch, "t"), now=TEST_NOW, bucket_rows=60)
    pipe.store.write("pipeline_control", _rows(spark, 900))
    control = pipe.table("pipeline_control")
    want = C.claim(control, C.worklist(control, "WEB_PAGE", ["NEW"], TEST_NOW, 3), "w1", TEST_NOW).control.toPandas()
    before = {b.id: b.folder for b in pipe.store.buckets("pipeline_control")}
    opened = []
    get = TableStore._get
    monkeypatch.setattr(TableStore, "_get", lambda self, table, buckets: opened.append([b.id for b in buckets]) or get(self, table, buckets))
    keys = pipe.claim("w1", "WEB_PAGE", max_rows=3)
    monkeypatch.undo()
    assert keys.count() == 3 and len(opened) == 1 and len(opened[0]) <= 3 < len(before)
    after = {b.id: b.folder for b in pipe.store.buckets("pipeline_control")}
    assert {i for i in before if before[i] != after[i]} == set(opened[0])
    got = pipe.table("pipeline_control").toPandas()
    order = ["url", "iteration"]
    assert got.sort_values(order, ignore_index=True).equals(want.sort_values(order, ignore_index=True))
    # claimed rows leave the queue with the same commit
    assert not set(_key_list(keys)) & set(_key_list(pipe.worklist("WEB_PAGE", ["NEW"])))
    assert all("queue-" in f for f in pipe.worklist("WEB_PAGE", ["NEW"]).inputFiles())


def test_a_run_reads_control_once_and_counts_as_it_writes(spark, scratch, monkeypatch):
    pipe = Pipeline(spark, os.path.join(scratch, "t"), scratch_dir=os.path.join(scratch, "s"), now=TEST_NOW, bucket_rows=60)
    pipe.bootstrap()
    pipe.store.write("pipeline_control", _rows(spark, 400))
    control = pipe.table("pipeline_control").toPandas()
    fetcher = TableFetcher(spark.createDataFrame([(f"u{i}", f"<p>text {i}</p>") for i in range(0, 200, 2)], "url string, html string"))
    listed = set(_key_list(pipe.worklist("WEB_PAGE", ["NEW"])))
    fetched = {k for k in listed if int(k[0][1:]) % 2 == 0}
    # a plan may be made of the whole table, but only the revision runs one
    revised = []
    revise = TableStore.revise
    monkeypatch.setattr(TableStore, "revise", lambda self, table, ids, *a: revised.append(list(ids)) or revise(self, table, ids, *a))
    assert pipe.scrape(fetcher) == {"found": len(listed), "claimed": len(listed), "completed": len(fetched), "enqueued_next": len(fetched)}
    assert len(revised) == 1
    got = {(r.url, r.iteration): (r.stage, r.status) for r in pipe.table("pipeline_control").collect()}
    for r in control.itertuples():
        k = (r.url, r.iteration)
        want = (("WEB_SUMMARY", "NEW") if k in fetched else ("WEB_PAGE", "ERROR")) if k in listed else (r.stage, r.status)
        assert got[k] == want
    assert pipe.scrape(fetcher) == dict.fromkeys(("found", "claimed", "completed", "enqueued_next"), 0)
    # the URL include list holds behind the limit
    some = spark.createDataFrame([("none",)], "url string")
    assert pipe.run_urls(3)["claimed"] == 3
    assert pipe.scrape(fetcher, max_rows=5, retry_errors=True, filter_urls=some)["found"] == 0


def test_queues_of_empty_and_old_tables(spark, scratch):
    import json
    pipe = Pipeline(spark, os.path.join(scratch, "t"), now=TEST_NOW, bucket_rows=50)
    pipe.bootstrap()
    assert pipe.worklist("URL", ["NEW"], 3).count() == 0 and pipe.run_urls()["found"] == 0
    pipe.store.write("pipeline_control", _rows(spark, 200))
    want = _key_list(pipe.worklist("URL", ["NEW"], 9))
    # a manifest written before queues were kept: the buckets themselves are read
    path = os.path.join(scratch, "t", "pipeline_control", "v=1")
    manifest = json.load(open(path))
    for b in manifest["buckets"]:
        del b["heads"]
    os.remove(os.path.join(os.path.dirname(path), ".v=1.crc"))
    json.dump(manifest, open(path, "w"))
    assert _key_list(pipe.worklist("URL", ["NEW"], 9)) == want
    pipe.run_urls()
    pipe.store.vacuum("pipeline_control", keep=1)
    left = os.listdir(os.path.join(scratch, "t", "pipeline_control"))
    named = {b.folder for b in pipe.store.buckets("pipeline_control")}
    assert {d for d in left if d.startswith("data-")} == named
    assert {d for d in left if d.startswith("queue-")} <= {d.replace("data-", "queue-") for d in named}
    assert pipe.worklist("URL", ["NEW"]).count() == 0


def test_a_revision_must_keep_every_row(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "t"))
    store.write("pipeline_control", _rows(spark, 20))
    ids = [b.id for b in store.buckets("pipeline_control")]
    with pytest.raises(RuntimeError, match="changed in number"):
        store.revise("pipeline_control", ids, lambda old: old.limit(3))
    assert store.read("pipeline_control").count() == 20


# ---------------------------------------------------------------- host-fair fetching
class _Page:
    status = 200

    class headers:
        @staticmethod
        def get_content_charset():
            return "utf-8"

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False

    def read(self):
        return b"<p>x</p>"


def _noting(folder):
    """An opener that notes when it was asked for which host."""
    def open_url(request, timeout):
        import time
        import uuid
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(f"{time.time()} {request.host}")
        return _Page()
    return open_url


def test_no_host_is_asked_more_often_than_its_pace(spark, scratch):
    """A host with most of all keys in several lanes and tasks; the others are not kept waiting for it."""
    from tablerail.sources.pages import FETCH_SCHEMA, HttpFetcher
    urls = [f"http://HOT.example:80/{i}" for i in range(90)] + [f"http://h{i % 10}.example/{i}" for i in range(40)] + ["no url"]
    keys = spark.createDataFrame([(u, 0) for u in urls], "url string, iteration int")
    fetcher = HttpFetcher(partitions=4, open_url=_noting(scratch), per_host=20, stripes=4)
    got = fetcher.fetch(keys)
    assert got.schema == FETCH_SCHEMA
    rows = got.collect()
    assert sorted(r.url for r in rows) == sorted(urls) and {r.url for r in rows if r.error} == {"no url"}
    asked = {}
    for name in os.listdir(scratch):
        at, host = open(os.path.join(scratch, name)).read().split()
        asked.setdefault(host.lower().split(":")[0], []).append(float(at))
    assert len(asked["hot.example"]) == 90 and len(asked) == 11
    for times in asked.values():
        times.sort()
        # at most 20 in any second (a hair less, as clocks are read apart from the wait)
        assert all(sum(t <= u < t + 0.99 for u in times) <= 20 for t in times)
    others = [t for h, times in asked.items() if h != "hot.example" for t in times]
    assert max(others) < max(asked["hot.example"])


def test_lanes_share_a_hosts_pace(spark):
    from tablerail.sources.pages import HttpFetcher, url_host
    for rate, stripes in ((0.5, 8), (1, 8), (5, 2), (7.5, 4), (100, 8)):
        f = HttpFetcher(per_host=rate, stripes=stripes)
        assert f.stripes / f.lane_interval() <= rate + 1e-9 and 1 <= f.stripes <= stripes
    with pytest.raises(ValueError):
        HttpFetcher(per_host=0)
    hosts = {"https://U:p@A.b:8/x": "a.b", "http://c?d": "c", "ftp://e": "e", "nothing": "", "http://": ""}
    got = spark.createDataFrame([(u,) for u in hosts], "u string").select("u", url_host("u").alias("h")).collect()
    assert {r.u: r.h for r in got} == hosts
