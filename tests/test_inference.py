"""Model calls: retry/backoff, rate metering, provider checks, offline model."""
import random

import pytest
from pyspark.sql import functions as F
import sys

from pyspark import cloudpickle

from tablerail.operators.inference import (BACKOFF_CAP, InferenceParams, RateLimiter, RetriableError, backoff_seconds,
                                           call_with_retry, check_provider, forget_answers, infer, infer_stored,
                                           read_answers)
from tablerail.testing import OfflineClient

# workers cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def test_backoff_bounds():
    rng = random.Random(1)
    for attempt in range(6):
        w = backoff_seconds(attempt, rng=rng)
        assert 1.25 ** attempt <= w <= min(BACKOFF_CAP, 1.25 ** attempt + 0.75)
    assert backoff_seconds(0, retry_after=30) == BACKOFF_CAP
    assert 3 <= backoff_seconds(0, retry_after=3, rng=rng) <= 3.75


def test_retry_then_success_is_metered():
    calls, sleeps, acquired = [], [], []

    class L(RateLimiter):
        def acquire(self):
            acquired.append(1)

    def fn():
        calls.append(1)
        if len(calls) < 3:
            raise RetriableError("429", retry_after=0)
        return "ok"
    r, e, n = call_with_retry(fn, L(None), sleep=sleeps.append)
    assert (r, e, n) == ("ok", None, 3)
    assert len(acquired) == 3 and len(sleeps) == 2


def test_retry_exhausted_and_hard_error():
    def always():
        raise RetriableError("503")
    r, e, n = call_with_retry(always, RateLimiter(None), max_attempts=5, sleep=lambda s: None)
    assert r is None and n == 5 and e.startswith("retries exhausted")

    def boom():
        raise KeyError("x")
    r, e, n = call_with_retry(boom, RateLimiter(None), sleep=lambda s: None)
    assert r is None and n == 1 and "KeyError" in e
    r, e, n = call_with_retry(lambda: "", RateLimiter(None))
    assert e == "empty response"


def test_rate_limiter_spacing():
    t = [0.0]
    slept = []

    def sleep(s):
        slept.append(s)
        t[0] += s
    lim = RateLimiter(60, clock=lambda: t[0], sleep=sleep)
    for _ in range(3):
        lim.acquire()
    assert slept == [1.0, 1.0]


def test_unknown_provider():
    with pytest.raises(ValueError):
        check_provider("mistral")
    assert check_provider(" OpenAI ") == "openai"


def test_offline_infer(spark):
    df = spark.createDataFrame([("u1", 0, "x\nCONTENT:\nA b. C d. E f.\n\nOutput Format: y"),
                                ("u2", 0, "x\nCONTENT:\n...\n\nOutput Format: y")], "url string, iteration int, prompt string")
    rows = {r.url: r for r in infer(df, "prompt", OfflineClient, InferenceParams(partitions=2)).collect()}
    assert rows["u1"].response.startswith('{"title": "A b."')
    assert rows["u1"].call_error is None and rows["u1"].attempts == 1
    assert rows["u2"].response.startswith("I could not")


class CountingClient:
    """Writes a line per call; fails the whole task while a marker file is there."""

    def __init__(self, log, trap):
        self.log, self.trap = log, trap

    def complete(self, system, prompt, temperature, max_tokens):
        import os
        with open(self.log, "a") as f:
            f.write(prompt + "\n")
        if prompt == "p13" and os.path.exists(self.trap):
            os._exit(1)  # the worker dies: not an error of one row
        return f"answer to {prompt}"


def questions(spark, log=None):
    """40 rows of 30 questions; each row read from the input is a line of the log."""
    def read(frames):
        for f in frames:
            with open(log, "a") as out:
                out.write("".join(f"{u}\n" for u in f["url"]))
            yield f
    df = spark.range(40).selectExpr("concat('u', id) AS url", "0 AS iteration", "concat('p', id % 30) AS prompt")
    return df.mapInPandas(read, df.schema) if log else df


def test_a_failed_run_repeats_only_unfinished_tasks(spark, scratch):
    import os
    from functools import partial
    log, trap, folder, rows = (os.path.join(scratch, x) for x in ("calls", "trap", "answers", "rows"))
    open(trap, "w").close()
    make, params = partial(CountingClient, log, trap), InferenceParams(partitions=2, rate_per_minute=1e9)
    with pytest.raises(Exception):
        infer_stored(questions(spark, rows), "prompt", make, params, folder, task_calls=3).collect()
    # the input was read once, though it is asked, dealt out and joined back
    assert sorted(open(rows).read().split()) == sorted(f"u{i}" for i in range(40))
    stored = {r.response.split()[-1] for r in read_answers(spark, folder).collect()}
    before = open(log).read().split()
    assert 0 < len(stored) < 30 and "p13" not in stored
    os.remove(trap)
    out = infer_stored(questions(spark), "prompt", make, params, folder, task_calls=3).collect()
    after = open(log).read().split()[len(before):]
    assert {r.url: r.response for r in out} == {f"u{i}": f"answer to p{i % 30}" for i in range(40)}
    assert sorted(after) == sorted({f"p{i}" for i in range(30)} - stored)  # one call a question
    assert infer_stored(questions(spark), "prompt", make, params, folder).count() == 40
    assert len(open(log).read().split()) == len(before) + len(after)
    forget_answers(spark, folder)
    assert not os.path.exists(folder)


class NamedClient:
    def __init__(self, name):
        self.name = name

    def complete(self, system, prompt, temperature, max_tokens):
        if prompt == "p7" and self.name == "bad":
            raise ValueError("no")
        return f"{self.name}: {prompt}"


def test_answers_belong_to_prompt_and_model(spark, scratch):
    import os
    from functools import partial
    folder = os.path.join(scratch, "answers")

    def run(name, df, **params):
        p = InferenceParams(partitions=2, rate_per_minute=1e9, **params)
        return {r.url: r.response for r in infer_stored(df, "prompt", partial(NamedClient, name), p, folder).collect()}
    df = questions(spark)
    assert run("a", df)["u3"] == "a: p3"
    assert run("b", df)["u3"] == "a: p3"  # the same question: stored
    assert run("b", df, model_id="other")["u3"] == "b: p3"
    assert run("c", df, temperature=0.9)["u3"] == "c: p3"
    assert run("d", df.withColumn("prompt", F.concat("prompt", F.lit("!"))))["u3"] == "d: p3!"
    # a failed call is not an answer
    first = run("bad", df, max_tokens=5)
    assert first["u7"] is None and first["u8"] == "bad: p8"
    assert run("good", df, max_tokens=5)["u7"] == "good: p7"


def test_every_crawl_of_a_url_has_its_summary_row(spark, scratch):
    """A URL on several pages: all their summaries are there, those that read alike too."""
    from tablerail.plans.catalog import load_all
    from tablerail.testing import compare_frames
    texts = ["one", "two", "two", "three", "four"]
    # the length of a URL decides the shape of its answer: all are made valid
    urls = ["https://a.example/x12", "https://a.example/x12", "https://a.example/x12", "https://a.example/x123", "https://a.example/xyz"]
    rows = [(i, u if len(u) % 4 < 2 else u + "/" * (4 - len(u) % 4), f"<p>page {t}</p>") for i, (u, t) in enumerate(zip(urls, texts, strict=True))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{scratch}/pages.parquet")
    import duckdb
    entry = load_all()["llm8_summary_rows"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{scratch}/pages.parquet/*.parquet')")
    got = entry.fn(spark, scratch).toPandas()
    assert len(got) == 5
    ok, why = compare_frames(got, con.execute(entry.sql).df())
    assert ok, why
