"""STM1: incremental seed ingest is keyed, so replays and re-runs change nothing."""
import json
import os

from tablerail.session import TEST_NOW
from tablerail.streaming.seed_stream import run_seed_stream


def _seed(path, entries):
    with open(path, "w") as f:
        json.dump(entries, f)


def test_stream_incremental_and_idempotent(spark, scratch):
    src, store, ckpt = (os.path.join(scratch, d) for d in ("in", "tables", "ckpt"))
    os.makedirs(src)
    _seed(os.path.join(src, "a.json"), [{"url": "https://a.example/1", "tags": ["x"]}])
    t1 = run_seed_stream(spark, src, store, ckpt, TEST_NOW)
    assert [r.url for r in t1.collect()] == ["https://a.example/1"]
    # nothing new: the checkpoint remembers the file
    t2 = run_seed_stream(spark, src, store, ckpt, TEST_NOW)
    assert t2.count() == 1
    # a new file in the other shape, repeating one URL with new tags
    _seed(os.path.join(src, "b.json"), {"urls": [{"url": " https://a.example/1 ", "tags": "y, z"},
                                                 {"url": "https://b.example/2"}]})
    t3 = {r.url: r.tags for r in run_seed_stream(spark, src, store, ckpt, TEST_NOW).collect()}
    assert t3 == {"https://a.example/1": "y,z", "https://b.example/2": None}


def test_stream_reports_bad_files_and_conflicts(spark, scratch):
    from tablerail.streaming.seed_stream import read_rejects
    src, store, ckpt = (os.path.join(scratch, d) for d in ("in", "tables", "ckpt"))
    os.makedirs(src)
    _seed(os.path.join(src, "a.json"), [{"url": "https://a.example/1"}, {"url": "https://b.example/1", "tags": ["x"]},
                                        {"url": "https://b.example/1", "tags": ["y"]}, {"link": 1}])
    with open(os.path.join(src, "cut.json"), "w") as f:
        f.write('{"urls": [')
    table = run_seed_stream(spark, src, store, ckpt, TEST_NOW)
    assert [r.url for r in table.collect()] == ["https://a.example/1"]
    bad = sorted((os.path.basename(r.file or ""), r.url or "", r.reason) for r in read_rejects(spark, store).collect())
    assert bad == [("", "https://b.example/1", "conflicting entries for one url"), ("a.json", "", "url is missing or blank"),
                   ("cut.json", "", "not valid JSON")]


def test_outcome_does_not_depend_on_batches(spark, scratch):
    """One URL in two files with different values: refused, however files are batched;
    a later load may change a URL."""
    from tablerail.streaming.seed_stream import read_rejects
    outcomes = []
    for n in (None, 1, 2):
        src, store, ckpt = (os.path.join(scratch, f"{d}{n}") for d in ("in", "tables", "ckpt"))
        os.makedirs(src)
        for i, source in enumerate("aba"):
            _seed(os.path.join(src, f"{i}.json"), [{"url": "https://x.example/", "source": source}, {"url": f"https://y.example/{i // 2}"}])
        table = run_seed_stream(spark, src, store, ckpt, TEST_NOW, max_files_per_trigger=n)
        outcomes.append((sorted((r.url, r.source) for r in table.collect()), [(r.url, r.reason) for r in read_rejects(spark, store).collect()]))
        _seed(os.path.join(src, "9.json"), [{"url": "https://x.example/", "source": "c"}, {"url": "https://y.example/0", "source": "new"}])
        later = run_seed_stream(spark, src, store, ckpt, TEST_NOW, max_files_per_trigger=n)
        assert {(r.url, r.source) for r in later.collect()} == {("https://x.example/", "c"), ("https://y.example/0", "new"), ("https://y.example/1", None)}
    assert outcomes[0] == outcomes[1] == outcomes[2]
    assert outcomes[0] == ([("https://y.example/0", None), ("https://y.example/1", None)], [("https://x.example/", "conflicting entries for one url")])


def test_a_load_that_died_is_applied_once(spark, scratch, monkeypatch):
    """A crash before the table's commit leaves the batches pending; one after it
    leaves folders that the next run only clears away."""
    from tablerail.sources.store import TableStore
    from tablerail.streaming import seed_stream
    src, store, ckpt = (os.path.join(scratch, d) for d in ("in", "tables", "ckpt"))
    os.makedirs(src)
    _seed(os.path.join(src, "a.json"), [{"url": "https://a.example/", "source": "1"}])
    monkeypatch.setattr(TableStore, "upsert", lambda *a, **k: 1 / 0)
    try:
        run_seed_stream(spark, src, store, ckpt, TEST_NOW)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    # the file is in the checkpoint, its entries are in the pending table
    assert [r.source for r in run_seed_stream(spark, src, store, ckpt, TEST_NOW).collect()] == ["1"]
    # a crash after the commit: the batch's folder is still there
    keep = seed_stream._file_system
    _seed(os.path.join(src, "b.json"), [{"url": "https://a.example/", "source": "2"}])

    class Stays:
        def exists(self, p):
            return keep(spark, p.toString())[1].exists(p)

        def listStatus(self, p):
            return keep(spark, p.toString())[1].listStatus(p)

        def delete(self, p, deep):
            return False
    monkeypatch.setattr(seed_stream, "_file_system", lambda s, path: (keep(s, path)[0], Stays()))
    run_seed_stream(spark, src, store, ckpt, TEST_NOW)
    monkeypatch.undo()
    _seed(os.path.join(src, "c.json"), [{"url": "https://a.example/", "source": "3"}])
    assert [r.source for r in run_seed_stream(spark, src, store, ckpt, TEST_NOW).collect()] == ["3"]
