"""Seed files, table store, dumps, the seed stream, the page fetcher."""
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.sources.pages import TableFetcher, page_rows
from tablerail.sources.seeds import flatten_seeds, ingest_seed_files, read_seed_entries, read_typed_json
from tablerail.sources.store import TableStore, dump_page_text
from tablerail.session import TEST_NOW
# workers cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])


SEEDS = [
    {"url": "https://en.example.org/wiki/A", "source": "demo", "tags": ["math", "geometry"]},
    {"url": " https://b.example.org/x ", "source": "manual", "tags": "biology, amphibians, mexican"},
    {"url": "https://c.example.org/", "tags": []},
    {"url": "https://d.example.org/"},
]


def _write(path, obj):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(obj, f)


def test_seed_shapes(spark, scratch):
    _write(os.path.join(scratch, "a.json"), SEEDS[:2])
    _write(os.path.join(scratch, "b.json"), {"urls": SEEDS[2:]})
    rows = {r.url: r for r in flatten_seeds(read_seed_entries(spark, scratch)).collect()}
    assert rows["https://en.example.org/wiki/A"].tags == "math,geometry"
    assert rows["https://b.example.org/x"].tags == "biology,amphibians,mexican"
    assert rows["https://c.example.org/"].tags is None
    assert rows["https://d.example.org/"].source is None


def test_bad_seeds_raise_or_are_reported(spark, scratch):
    from tablerail.sources.seeds import seed_rejects
    _write(os.path.join(scratch, "good.json"), SEEDS[:1])
    _write(os.path.join(scratch, "shape.json"), {"links": [1, 2]})
    _write(os.path.join(scratch, "rows.json"), [{"url": "https://ok.example/"}, {"link": "x"}, {"url": "  "}, {"url": 7}, 5, None])
    with open(os.path.join(scratch, "cut.json"), "w") as f:
        f.write('[{"url": "https://x.exa')
    with pytest.raises(Exception, match="bad seed in"):
        read_seed_entries(spark, scratch).collect()
    with pytest.raises(Exception, match="bad seed in"):
        ingest_seed_files(spark, scratch, spark.createDataFrame([], S.URL.schema), TEST_NOW).collect()
    got = {r.url for r in flatten_seeds(read_seed_entries(spark, scratch, bad="skip")).collect()}
    assert got == {"https://en.example.org/wiki/A", "https://ok.example/"}
    bad = sorted((os.path.basename(r.file), -1 if r.pos is None else r.pos, r.reason) for r in seed_rejects(spark, scratch).collect())
    url, entry = "url is missing or blank", "entry is not an object"
    assert bad == [("cut.json", -1, "not valid JSON"), ("rows.json", 1, url), ("rows.json", 2, url), ("rows.json", 3, url),
                   ("rows.json", 4, entry), ("rows.json", 5, entry), ("shape.json", -1, "neither a list of entries nor {urls: [...]}")]


def test_ingest_missing_file_is_noop(spark, scratch):
    empty = spark.createDataFrame([], S.URL.schema)
    out = ingest_seed_files(spark, os.path.join(scratch, "missing.json"), empty, TEST_NOW)
    assert out.count() == 0
    _write(os.path.join(scratch, "a.json"), SEEDS)
    out = ingest_seed_files(spark, [os.path.join(scratch, "a.json")], empty, TEST_NOW)
    again = ingest_seed_files(spark, [os.path.join(scratch, "a.json")], out, TEST_NOW)
    assert out.count() == again.count() == 4


def test_typed_json_fails_fast(spark, scratch):
    p = os.path.join(scratch, "t.json")
    with open(p, "w") as f:
        f.write('[{"url": "u", "n": "not a number"}]')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("n", T.IntegerType())])
    with pytest.raises(Exception):
        read_typed_json(spark, p, schema).collect()


def test_store_versions_and_bootstrap(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "tables"))
    assert store.bootstrap(["url", "web_page", "nope"]) == {"url": True, "web_page": True, "nope": False}
    assert store.read("url").count() == 0
    rows = spark.createDataFrame([("u", "s", None, None, None)], S.URL.schema)
    assert store.write("url", rows) == 1
    assert store.read("url").count() == 1
    assert store.bootstrap(["url"]) == {"url": True} and store.read("url").count() == 1


def test_dump_text(spark, scratch):
    df = spark.createDataFrame([("u1", "t1"), ("u2", None)], "url string, clean_text string")
    dump_page_text(df, os.path.join(scratch, "d"), "txt")
    lines = [r.value for r in spark.read.text(os.path.join(scratch, "d")).collect()]
    assert "--- u1 ---" in lines and "t1" in lines
    dump_page_text(df, os.path.join(scratch, "j"), "json")
    assert spark.read.json(os.path.join(scratch, "j")).count() == 2
    with pytest.raises(ValueError):
        dump_page_text(df, os.path.join(scratch, "x"), "xml")


def test_page_rows_failures(spark):
    pages = spark.createDataFrame([("u1", "<p>hi https://x.y</p>"), ("u2", "<p> </p>"), ("u3", "<p>https://x.y</p>")],
                                  "url string, html string")
    keys = spark.createDataFrame([("u1", 0), ("u2", 0), ("u3", 0), ("u4", 0)], "url string, iteration int")
    rows = {r.url: r for r in page_rows(TableFetcher(pages).fetch(keys), TEST_NOW).collect()}
    assert rows["u1"].ok and rows["u1"].clean_text == "hi"
    assert not rows["u2"].ok and rows["u2"].fetch_error == "FETCH_FAILED"
    # text made only of a URL still counts as fetched, with empty clean text (Q33)
    assert rows["u3"].ok and rows["u3"].clean_text == ""
    assert not rows["u4"].ok and rows["u4"].fetch_error == "FETCH_FAILED"


def test_store_vacuum(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "tables"))
    store.bootstrap(["url"])
    rows = spark.createDataFrame([("u", "s", None, None, None)], S.URL.schema)
    for _ in range(3):
        store.write("url", rows)
    assert store.vacuum("url", keep=2) == [0, 1]
    assert store.read("url").count() == 1
    with pytest.raises(ValueError):
        store.vacuum("url", keep=0)


def _urls(spark, n):
    return spark.range(n).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("s").alias("source"), *[
        F.lit(None).cast(S.URL.dtype(c)).alias(c) for c in ("tags", "created_at", "updated_at")])


def _control(spark, keys):
    """(url, iteration, stage, status) as control rows."""
    rows = spark.createDataFrame(keys, "url string, iteration int, stage string, status string")
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(S.PIPELINE_CONTROL.dtype(c)).alias(c)
                         for c in S.PIPELINE_CONTROL.columns])


def test_upsert_rewrites_only_the_buckets_of_its_keys(spark, scratch):
    from tablerail.operators.upsert import upsert
    store = TableStore(spark, os.path.join(scratch, "tables"), bucket_rows=40)
    rows = _urls(spark, 500)
    store.write("url", rows)
    before = {b.id: b for b in store.buckets("url")}
    assert len(before) >= 13 and all(b.rows <= 40 for b in before.values()) and sum(b.rows for b in before.values()) == 500
    batch = rows.where("url IN ('u1', 'u2')").withColumn("source", F.lit("new")).unionByName(
        rows.limit(1).withColumn("url", F.lit("other")).withColumn("source", F.lit("new")))
    hit = store.touched("url", batch)
    store.upsert("url", batch, lambda old, b: upsert(old, b, S.URL, TEST_NOW))
    after = {b.id: b for b in store.buckets("url")}
    assert 1 <= len(hit) <= 3 and {i for i, b in before.items() if i not in after or after[i].folder != b.folder} == set(hit)
    got = {r.url: r.source for r in store.read("url").collect()}
    assert len(got) == 501 and {u for u, s in got.items() if s == "new"} == {"u1", "u2", "other"}
    assert store.upsert("url", batch.limit(0), lambda old, b: old) == 1  # nothing to write: the version stays


def test_buckets_split_as_a_table_grows(spark, scratch):
    """Loaded step by step: buckets split, each file stays bounded, no row is lost."""
    from tablerail.operators.upsert import upsert
    store = TableStore(spark, os.path.join(scratch, "tables"), bucket_rows=50)
    store.bootstrap(["url"])
    sizes = []
    for n in (30, 90, 400, 1000):
        store.upsert("url", _urls(spark, n).where(f"int(substr(url, 2)) >= {n // 4}"), lambda old, b: upsert(old, b, S.URL, TEST_NOW))
        buckets = store.buckets("url")
        sizes.append(len(buckets))
        assert all(b.rows <= 50 for b in buckets)
        for b in buckets:
            # the directory covers every key exactly once
            assert sum(o.uval == b.uval & ((1 << o.ubits) - 1) for o in buckets if o.ubits <= b.ubits and not o.kbits) == 1
    assert sizes == sorted(sizes) and sizes[0] == 1 and sizes[-1] > 16
    want = {f"u{i}" for n in (30, 90, 400, 1000) for i in range(n // 4, n)}
    assert {r.url for r in store.read("url").collect()} == want


def test_a_large_table_has_a_bounded_directory(spark, scratch, monkeypatch):
    """Small buckets asked for: from a full directory on they grow instead of their number,
    up to the table's own size; no row is lost and counts hold."""
    from tablerail.sources import store as ST
    monkeypatch.setattr(ST, "FULL_DIRECTORY", 8)
    monkeypatch.setitem(ST.BUCKET_ROWS, "pipeline_control", 60)
    store = TableStore(spark, os.path.join(scratch, "tables"), bucket_rows=5)
    store.bootstrap(["pipeline_control"])
    for n in range(3):
        rows = _control(spark, [(f"u{i}", n, "URL", "NEW") for i in range(100)])
        store.upsert("pipeline_control", rows, lambda old, b: old.unionByName(b))
        buckets = store.buckets("pipeline_control")
        assert 5 < max(b.rows for b in buckets) <= 60 and len(buckets) <= 2 * 8
    assert store.counts("pipeline_control") == [("URL", "NEW", 300)] and store.read("pipeline_control").distinct().count() == 300
    assert store._limit("pipeline_control", 10**6) == 60 and TableStore(spark, scratch)._limit("pipeline_control", 10) == 60


def test_a_hot_url_is_cut_by_the_whole_key(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "tables"), bucket_rows=50)
    rows = _control(spark, [("hot", i, "URL", "NEW") for i in range(600)] + [(f"u{i}", 0, "DONE", "NEW") for i in range(300)])
    store.write("pipeline_control", rows)
    buckets = store.buckets("pipeline_control")
    assert any(b.kbits for b in buckets) and max(b.rows for b in buckets) < 120
    more = _control(spark, [("hot", i, "URL", "NEW") for i in range(600, 900)])
    store.upsert("pipeline_control", more, lambda old, b: old.unionByName(b))
    assert store.read("pipeline_control").count() == 1200 and max(b.rows for b in store.buckets("pipeline_control")) < 120
    assert store.lookup("pipeline_control", spark.createDataFrame([("hot",)], "url string")).count() == 900


def test_a_lookup_opens_only_buckets_of_its_urls(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "tables"), bucket_rows=40)
    store.write("url", _urls(spark, 1000))
    wanted = spark.createDataFrame([("u5",), ("u6",), ("u5",), ("none",)], "url string")
    found = store.lookup("url", wanted)
    assert sorted(r.url for r in found.collect()) == ["u5", "u6"]
    opened = {f.split("_bucket=")[1].split("/")[0] for f in store._get("url", store.buckets("url")).inputFiles()}
    some = {f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles() if "_bucket=" in f}
    assert len(opened) > 25 and 1 <= len(some) <= 3


def test_progress_is_kept_with_the_buckets(spark, scratch):
    """After random commits the counts equal a recount, and need no data file."""
    import random
    import shutil

    from tablerail.operators.queries import progress_counts
    from tablerail.plans.pipeline import Pipeline
    rng = random.Random(4)
    pipe = Pipeline(spark, os.path.join(scratch, "tables"), bucket_rows=20)
    pipe.bootstrap()
    for _ in range(5):
        keys = {(f"u{rng.randrange(60)}", rng.randrange(3)) for _ in range(30)}
        batch = _control(spark, [(u, i, rng.choice(["URL", "DONE", None]), rng.choice(["NEW", "ERROR"])) for u, i in keys])
        pipe.store.upsert("pipeline_control", batch,
                          lambda old, b: old.join(b.select("url", "iteration"), ["url", "iteration"], "left_anti").unionByName(b))
        recount = sorted(map(str, progress_counts(pipe.table("pipeline_control")).select("stage", "status", "count").collect()))
        assert sorted(map(str, pipe.progress().collect())) == recount
    for d in os.listdir(os.path.join(scratch, "tables", "pipeline_control")):
        if d.startswith("data-"):
            shutil.move(os.path.join(scratch, "tables", "pipeline_control", d), os.path.join(scratch, d))
    assert sorted(map(str, pipe.progress().collect())) == recount


def test_a_write_that_died_blocks_nothing(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "tables"))
    store.bootstrap(["url"])
    rows = spark.createDataFrame([("u", "s", None, None, None)], S.URL.schema)
    broken = rows.withColumn("source", F.raise_error(F.lit("killed")).cast("string"))
    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            store.write("url", broken)
    assert store.read("url").count() == 0
    assert store.write("url", rows) == 1 and store.read("url").count() == 1
    store.vacuum("url", keep=1)
    left = [d for d in os.listdir(os.path.join(scratch, "tables", "url")) if d.startswith("data-")]
    assert left == [store.buckets("url")[0].folder] and store.read("url").count() == 1


def test_materialized_folders_are_released(spark, scratch):
    from tablerail.sources import store as st
    df = st.materialize(spark.range(3).toDF("id"), scratch)
    path = st._MATERIALIZED[-1].removeprefix("file:")
    assert df.count() == 3 and os.path.exists(path)
    st.release_materialized(spark)
    assert not os.path.exists(path)


def test_table_fetcher_with_repeated_urls(spark):
    pages = spark.createDataFrame([("u", "<p>old</p>", 1), ("u", "<p>new</p>", 2), ("u", "<p>mid</p>", 1)], "url string, html string, at int")
    keys = spark.createDataFrame([("u", 0), ("u", 1)], "url string, iteration int")
    got = TableFetcher(pages, version_col="at").fetch(keys).collect()
    assert sorted((r.iteration, r.html) for r in got) == [(0, "<p>new</p>"), (1, "<p>new</p>")]


class _Answer:
    """What a URL opener returns, without a network."""
    status = 200

    def __init__(self, body):
        import email.message
        self.body, self.headers = body, email.message.Message()

    def read(self):
        return self.body

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def _stub_open(request, timeout):
    if request.full_url.endswith("missing"):
        raise OSError("no route")
    assert timeout == 8.0 and request.headers["User-agent"].startswith("tablerail")
    return _Answer(f"<p>{request.full_url}</p>".encode())


def test_http_fetcher_with_a_stub_opener(spark):
    from tablerail.sources.pages import HttpFetcher
    keys = spark.range(100).select(F.when(F.col("id") == 7, F.lit("http://h/missing")).otherwise(F.concat(F.lit("http://h/"), "id")).alias("url"),
                                   F.lit(0).alias("iteration"))
    got = {r.url: r for r in HttpFetcher(partitions=3, open_url=_stub_open).fetch(keys).collect()}
    assert len(got) == 100 and got["http://h/missing"].error == "OSError: no route" and got["http://h/missing"].html is None
    assert got["http://h/5"].html == "<p>http://h/5</p>" and got["http://h/5"].status_code == 200

def test_ingest_collapses_copies_and_rejects_conflicts(spark, scratch):
    import pytest
    empty = spark.createDataFrame([], S.URL.schema)
    _write(os.path.join(scratch, "x.json"), [{"url": "https://a.example/1", "tags": ["t"]}])
    _write(os.path.join(scratch, "y.json"), [{"url": " https://a.example/1 ", "tags": ["t"]}])
    out = ingest_seed_files(spark, [os.path.join(scratch, "x.json"), os.path.join(scratch, "y.json")], empty, TEST_NOW)
    assert out.count() == 1
    _write(os.path.join(scratch, "z.json"), [{"url": "https://a.example/1", "tags": ["other"]}])
    with pytest.raises(Exception, match="duplicate primary keys"):
        ingest_seed_files(spark, [os.path.join(scratch, "x.json"), os.path.join(scratch, "z.json")], empty, TEST_NOW).collect()
