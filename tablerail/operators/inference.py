"""Batch model inference (LLM1–LLM3, LLM8).

``infer`` runs a model client over a prompt column with ``mapInPandas``: one
client per partition, Arrow batches in and out, the per-row failure captured
as a column (never an exception that kills the job).  The provider's global
rate is split evenly across the partitions doing the calls, and every attempt
is metered.  Calls have side effects (cost), so callers must write the
result before branching on it (see ``plans.stages``)."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.functions.payload import validate_responses
from tablerail.functions.text import normalize_provider
from tablerail.sources.store import materialize

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Requests per minute by provider (global, all partitions together).
RATE_PER_MINUTE = {"openai": 1000, "anthropic": 50}
# Retry: attempts, exponential base, cap in seconds, jitter upper bound.
MAX_ATTEMPTS = 5
BACKOFF_BASE = 1.25
BACKOFF_CAP = 12.0
JITTER = 0.75
# System text per provider.
SYSTEM_TEXT = {
    "openai": "You are a helpful assistant.",
    "anthropic": "You are a helpful assistant who adheres to instructions.",
}
DEFAULT_MODEL = "gpt-4.1-nano"


@dataclass(frozen=True)
class InferenceParams:
    provider: str = S.DEFAULT_PROVIDER
    model_id: str = DEFAULT_MODEL
    temperature: float = 0.3
    max_tokens: int = 1024
    expected: str = "json"
    json_type: str = "web_summary"
    # Partitions doing calls = the concurrency of the stage.
    partitions: int | None = None
    rate_per_minute: float | None = None
    max_attempts: int = MAX_ATTEMPTS


class RetriableError(Exception):
    """Raised by clients for 429/5xx/timeouts; ``retry_after`` in seconds if the server said so."""

    def __init__(self, msg: str, retry_after: float | None = None):
        super().__init__(msg)
        self.retry_after = retry_after


def check_provider(provider: str) -> str:
    """Unknown providers fail before the job starts."""
    p = (provider or "").strip().lower()
    if p not in SYSTEM_TEXT:
        raise ValueError(f"unsupported llm_provider: {provider!r}")
    return p


def backoff_seconds(attempt: int, retry_after: float | None = None, rng: random.Random | None = None) -> float:
    """Wait before the next attempt: server hint or ``1.25**attempt``, plus jitter, capped."""
    rng = rng or random
    base = retry_after if retry_after is not None else BACKOFF_BASE ** attempt
    return min(BACKOFF_CAP, base + rng.uniform(0, JITTER))


class RateLimiter:
    """Token bucket for one partition's share of the global rate."""

    def __init__(self, per_minute: float | None, clock=time.monotonic, sleep=time.sleep):
        self.interval = 60.0 / per_minute if per_minute else 0.0
        self.clock, self.sleep = clock, sleep
        self.next_at = 0.0

    def acquire(self) -> None:
        if not self.interval:
            return
        now = self.clock()
        if now < self.next_at:
            self.sleep(self.next_at - now)
            now = self.next_at
        self.next_at = now + self.interval


def call_with_retry(fn: Callable[[], str], limiter: RateLimiter, max_attempts: int = MAX_ATTEMPTS,
                    sleep=time.sleep) -> tuple[str | None, str | None, int]:
    """Run ``fn`` metered and retried; returns (response, error, attempts)."""
    for attempt in range(max_attempts):
        limiter.acquire()
        try:
            out = fn()
            if out is None or (isinstance(out, str) and out == ""):
                return None, "empty response", attempt + 1
            return out, None, attempt + 1
        except RetriableError as e:
            if attempt < max_attempts - 1:
                sleep(backoff_seconds(attempt, e.retry_after))
                continue
            return None, f"retries exhausted: {e}", attempt + 1
        except Exception as e:  # noqa: BLE001 - per-row failure is data, not a crash
            return None, f"{type(e).__name__}: {e}", attempt + 1
    return None, "no attempt", 0


# Prompts handed to one client call loop at a time: what a task has answered is
# passed on after so many calls, and so little waits in memory.
YIELD_ROWS = 64


def _client_partition(client_factory, params: InferenceParams, rate_share: float | None, prompt_col: str):
    system = SYSTEM_TEXT[params.provider]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        limiter = RateLimiter(rate_share)
        for pdf in (b.iloc[k:k + YIELD_ROWS] for b in batches for k in range(0, len(b), YIELD_ROWS)):
            responses, errors, attempts = [], [], []
            for prompt in pdf[prompt_col].tolist():
                r, e, n = call_with_retry(
                    lambda p=prompt: client.complete(system, p, params.temperature, params.max_tokens),
                    limiter, params.max_attempts)
                responses.append(r)
                errors.append(e)
                attempts.append(n)
            out = pdf.drop(columns=[prompt_col])
            out["response"] = responses
            out["call_error"] = errors
            out["attempts"] = attempts
            yield out
    return run


def infer(df: DataFrame, prompt: Column | str, client_factory: Callable[[], object], params: InferenceParams,
          keep: tuple[str, ...] = ("url", "iteration"), tasks: int | None = None) -> DataFrame:
    """LLM2 + LLM3: one model call per row of ``df``.

    ``prompt``: a column name or an expression over ``df``; it is evaluated after
    the rows are dealt out, so no rendered prompt is shuffled.  ``tasks``: how many
    tasks the calls are dealt over, if more than run at once.  Output: ``keep``
    columns, ``response``, ``call_error``, ``attempts``."""
    provider = check_provider(params.provider)
    params = InferenceParams(**{**params.__dict__, "provider": provider})
    parts = params.partitions or df.sparkSession.sparkContext.defaultParallelism
    # a client may declare its own budget (an offline model has none)
    client_rate = getattr(client_factory, "rate_per_minute", "provider")
    rate = params.rate_per_minute or (RATE_PER_MINUTE.get(provider) if client_rate == "provider" else client_rate)
    # the rate is shared by the tasks that run at the same time
    share = (rate / parts) if rate else None
    prompt_col = "_prompt"
    src = df.repartition(tasks or parts, *keep).select(*keep, (F.col(prompt) if isinstance(prompt, str) else prompt).alias(prompt_col))
    fields = [src.schema[k] for k in keep] + [
        T.StructField("response", T.StringType()), T.StructField("call_error", T.StringType()),
        T.StructField("attempts", T.IntegerType())]
    return src.mapInPandas(_client_partition(client_factory, params, share, prompt_col), T.StructType(fields))


def _path(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# Calls in one task of a stored run, about: what a lost task repeats.
TASK_CALLS = 2_000
ANSWER = "ask string, response string, call_error string, attempts int"


def ask_key(prompt: Column, params: InferenceParams) -> Column:
    """The address of a question: a hash of everything the answer depends on."""
    fixed = json.dumps([check_provider(params.provider), params.model_id, params.temperature, params.max_tokens,
                        SYSTEM_TEXT[check_provider(params.provider)]])
    return F.sha2(F.concat(F.lit(fixed + "\n"), F.coalesce(prompt, F.lit(""))).cast("binary"), 256)


def read_answers(spark, folder: str) -> DataFrame:
    """(ask, response, call_error, attempts): the log, one row a question; an
    answer counts before failed calls."""
    p, fs = _path(spark, folder)
    log = spark.read.schema(ANSWER).parquet(folder) if fs.exists(p) else spark.createDataFrame([], ANSWER)
    best = F.min(F.struct(F.col("call_error").isNotNull().alias("failed"), "response", "call_error", "attempts")).alias("b")
    return log.groupBy("ask").agg(best).select("ask", "b.response", "b.call_error", "b.attempts")


def infer_stored(df: DataFrame, prompt: Column | str, client_factory: Callable[[], object], params: InferenceParams,
                 folder: str, keep: tuple[str, ...] = ("url", "iteration"), task_calls: int = TASK_CALLS) -> DataFrame:
    """``infer`` with a log of answers in ``folder``, by the content of the question.

    The log's key is a hash of the prompt and all parameters, so another text,
    model or setting is another question, and rows that ask the same are one call.
    The input plan runs once and is stored; one job then calls for the questions
    without an answer.  Its tasks commit their answers one by one as they end, so a
    run that dies repeats only the calls of its unfinished tasks (of about
    ``task_calls`` each).  Failed calls count as not answered."""
    spark = df.sparkSession
    asked = materialize(df.withColumn("_ask", ask_key(F.col(prompt) if isinstance(prompt, str) else prompt, params)))
    answered = read_answers(spark, folder).where("call_error IS NULL").select(F.col("ask").alias("_ask"))
    inputs = [c for c in asked.columns if c != "_ask"]
    todo = (asked.join(answered, "_ask", "left_anti").groupBy("_ask")
            .agg(F.first(F.struct(*inputs)).alias("_in")).select("_ask", "_in.*"))
    todo = materialize(todo)
    calls = todo.count()
    if calls:
        at_once = params.partitions or spark.sparkContext.defaultParallelism
        said = infer(todo, prompt, client_factory, params, ("_ask",), tasks=max(at_once, math.ceil(calls / task_calls)))
        # algorithm 2: a task's file is in its place when the task ends, not when the job does
        (said.withColumnRenamed("_ask", "ask").write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .parquet(folder))
    answers = read_answers(spark, folder).withColumnRenamed("ask", "_ask")
    return asked.select(*keep, "_ask").join(answers, "_ask", "left").select(*keep, "response", "call_error", "attempts")


def forget_answers(spark, folder: str) -> None:
    """Remove stored answers once their results are kept elsewhere."""
    p, fs = _path(spark, folder)
    fs.delete(p, True)


RAW_RESPONSE_COLUMNS = ("response", "call_error", "attempts")


def summary_rows(responses: DataFrame, params: InferenceParams, now, keep_raw: bool = False) -> DataFrame:
    """LLM4–LLM6 + STR7 + LLM8: validated responses → ``web_summary`` rows plus ``error``
    (and, with ``keep_raw``, the raw ``response``, ``call_error`` and ``attempts``).

    A row is a failure when the call failed or the payload is invalid."""
    from tablerail.session import ts
    v = validate_responses(responses, "response", params.expected, params.json_type)
    err = F.coalesce(F.col("call_error"), F.col("error"))
    return v.select(
        "url", "iteration",
        normalize_provider(F.lit(params.provider)).alias("llm_provider"),
        F.lit(params.model_id).alias("model_id"),
        "summary_text", "summary_json",
        F.lit(None).cast("int").alias("tokens_prompt"),
        F.lit(None).cast("int").alias("tokens_completion"),
        F.lit(None).cast("int").alias("tokens_total"),
        ts(now).alias("created_at"),
        ts(now).alias("updated_at"),
        err.alias("error"),
        *([F.col(c) for c in RAW_RESPONSE_COLUMNS] if keep_raw else []),
    )
