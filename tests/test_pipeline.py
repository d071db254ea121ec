"""The stored-table pipeline: commands over versioned tables, end to end."""
import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from tablerail.plans.fixtures import read_table
from tablerail.plans.pipeline import Pipeline
from tablerail.session import TEST_NOW
from tablerail.sources.pages import TableFetcher
from tablerail.testing import OfflineClient


def test_batches_until_done(spark, scratch):
    pages = read_table(spark, SF001, "pages")
    seeds = os.path.join(scratch, "seeds.json")
    with open(seeds, "w") as f:
        json.dump([{"url": r.url, "source": "pages"} for r in pages.select("url").collect()], f)
    pipe = Pipeline(spark, os.path.join(scratch, "store"), scratch_dir=os.path.join(scratch, "tmp"), now=TEST_NOW)
    pipe.bootstrap()
    pipe.ingest(seeds)
    pipe.sync()
    assert pipe.run_urls() == {"found": 50, "claimed": 50, "completed": 50, "enqueued_next": 50}
    fetcher = TableFetcher(pages)
    # explicit batches of 20 rows until nothing is left
    found = [pipe.scrape(fetcher, max_rows=20)["found"] for _ in range(4)]
    assert found == [20, 20, 10, 0]
    assert pipe.summarize(OfflineClient)["enqueued_next"] == 50
    counts = {(r.stage, r.status): r["count"] for r in pipe.progress().collect()}
    assert counts == {("DONE", "NEW"): 50}
    assert pipe.table("web_summary").count() == 50
    # the control table stays unique on its key
    c = pipe.table("pipeline_control")
    assert c.groupBy("url", "iteration").count().where("count > 1").count() == 0
    # nothing COMPLETED is left to advance
    pipe.advance_completed()
    assert pipe.table("pipeline_control").where(F.col("stage") == "DONE").count() == 50


def test_cli_parser():
    from tablerail.__main__ import build_parser
    import pytest
    a = build_parser().parse_args(["--store", "/x", "scrape", "--max-rows", "3", "--retry-errors"])
    assert (a.command, a.max_rows, a.retry_errors) == ("scrape", 3, True)
    assert build_parser().parse_args(["--store", "/x", "scrape"]).max_rows is None
    for command in ("summarize", "all"):  # no made-up summaries: a client is required
        with pytest.raises(SystemExit):
            build_parser().parse_args(["--store", "/x", command])


def test_all_needs_no_page_table_and_reaches_every_page(spark, scratch, monkeypatch, capsys):
    """``all`` from the command line: fetching without a page table, every row, no cap."""
    from tablerail import __main__ as cli
    from tablerail.sources import pages as pg
    from test_sources import _stub_open
    monkeypatch.setattr(pg, "_open", _stub_open)
    seeds = os.path.join(scratch, "seeds.json")
    with open(seeds, "w") as f:
        json.dump([{"url": f"http://h/{i}"} for i in range(60)], f)
    cli.main(["--store", os.path.join(scratch, "store"), "all", "--seeds", seeds, "--client", "tablerail.testing:OfflineClient"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["pages"] == {"found": 60, "claimed": 60, "completed": 60, "enqueued_next": 60}
    # the stub's pages hold nothing but a URL, so no summary is made of them
    assert out["summaries"]["found"] == 60 and out["summaries"]["completed"] == 0


def test_cli_end_to_end(spark, scratch, capsys):
    from tablerail.__main__ import main
    pages = read_table(spark, SF001, "pages")
    pages_path = os.path.join(scratch, "crawl.parquet")
    pages.select("url", "html").write.parquet(pages_path)
    seeds = os.path.join(scratch, "seeds.json")
    with open(seeds, "w") as f:
        json.dump({"urls": [{"url": r.url, "tags": "a, b"} for r in pages.select("url").collect()]}, f)
    store = os.path.join(scratch, "store")
    for argv in (["bootstrap"], ["ingest", seeds], ["sync"], ["urls"],
                 ["scrape", "--pages-table", pages_path], ["summarize", "--client", "tablerail.testing:OfflineClient"]):
        main(["--store", store] + argv)
    capsys.readouterr()
    main(["--store", store, "progress"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == [{"stage": "DONE", "status": "NEW", "count": 50}]
