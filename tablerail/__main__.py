"""Command line: ``python -m tablerail --store DIR <command> ...``.

Commands mirror the pipeline: ``bootstrap``, ``ingest``, ``sync``, ``urls``,
``scrape``, ``summarize``, ``all``, ``advance-completed``, ``progress``, ``status``.
The model client is ``module:callable``; commands that call a model require it."""

from __future__ import annotations

import argparse
import importlib
import json


def _client(spec: str):
    mod, _, name = spec.partition(":")
    return getattr(importlib.import_module(mod), name)


def _fetcher(spark, args):
    from tablerail.sources.pages import HttpFetcher, TableFetcher
    if args.pages_table:
        return TableFetcher(spark.read.parquet(args.pages_table))
    return HttpFetcher(partitions=args.fetch_tasks, per_host=args.per_host)


def _fetch_arguments(p: argparse.ArgumentParser) -> None:
    p.add_argument("--pages-table", default=None, help="parquet table (url, html) used as the fetcher")
    p.add_argument("--fetch-tasks", type=int, default=None, help="tasks the URLs are dealt over (default: shuffle width)")
    p.add_argument("--per-host", type=float, default=None, help="requests a second that one host gets at most (default: no pace)")


def _model_arguments(p: argparse.ArgumentParser) -> None:
    p.add_argument("--provider", default="openai", choices=["openai", "anthropic"])
    p.add_argument("--model", default=None)
    p.add_argument("--client", required=True, help="model client factory as module:callable")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablerail", description="table-driven URL → page → summary pipeline")
    p.add_argument("--store", required=True, help="root folder of the versioned tables")
    p.add_argument("--master", default=None)
    p.add_argument("--bucket-rows", type=int, default=None, help="rows from which a bucket of a stored table splits")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("bootstrap")
    ing = sub.add_parser("ingest")
    ing.add_argument("seeds", nargs="+")
    sy = sub.add_parser("sync")
    sy.add_argument("--iteration", type=int, default=0)
    sy.add_argument("--mode", choices=["append", "replace"], default="append")
    u = sub.add_parser("urls")
    u.add_argument("--max", type=int, default=None)
    cl = sub.add_parser("claim", help="lease the oldest claimable rows of a stage to a worker")
    cl.add_argument("stage", choices=["URL", "WEB_PAGE", "WEB_SUMMARY"])
    cl.add_argument("--worker", required=True)
    cl.add_argument("--max-rows", type=int, default=None, help="claim at most so many rows (default: all)")
    for name in ("scrape", "summarize"):
        s = sub.add_parser(name)
        s.add_argument("--max-rows", type=int, default=None, help="process at most so many rows (default: all)")
        s.add_argument("--retry-errors", action="store_true")
        if name == "scrape":
            _fetch_arguments(s)
        else:
            _model_arguments(s)
    a = sub.add_parser("all")
    a.add_argument("--seeds", nargs="*", default=None)
    a.add_argument("--max-scrape", type=int, default=None, help="pages fetched at most (default: all)")
    a.add_argument("--max-summarize", type=int, default=None, help="pages summarised at most (default: all)")
    a.add_argument("--retry-errors", action="store_true")
    _fetch_arguments(a)
    _model_arguments(a)
    sub.add_parser("advance-completed")
    sub.add_parser("progress")
    st = sub.add_parser("status", help="control rows of some URLs")
    st.add_argument("urls", nargs="+")
    return p


def main(argv=None) -> None:
    args = build_parser().parse_args(argv)
    from tablerail.operators.inference import DEFAULT_MODEL, InferenceParams
    from tablerail.plans.pipeline import Pipeline
    from tablerail.session import build_session
    spark = build_session(args.master)
    pipe = Pipeline(spark, args.store, bucket_rows=args.bucket_rows)
    cmd = args.command
    if cmd == "bootstrap":
        out = pipe.bootstrap()
    elif cmd == "ingest":
        out = {"url_version": pipe.ingest(args.seeds)}
    elif cmd == "sync":
        out = {"control_version": pipe.sync(args.iteration, args.mode)}
    elif cmd == "urls":
        out = pipe.run_urls(args.max)
    elif cmd == "claim":
        out = {"claimed": pipe.claim(args.worker, args.stage, max_rows=args.max_rows).count()}
    elif cmd == "scrape":
        out = pipe.scrape(_fetcher(spark, args), args.max_rows, args.retry_errors)
    elif cmd == "summarize":
        params = InferenceParams(provider=args.provider, model_id=args.model or DEFAULT_MODEL)
        out = pipe.summarize(_client(args.client), params, args.max_rows, args.retry_errors)
    elif cmd == "all":
        params = InferenceParams(provider=args.provider, model_id=args.model or DEFAULT_MODEL)
        out = pipe.run_all(args.seeds, _fetcher(spark, args), _client(args.client), params,
                           args.max_scrape, args.max_summarize, args.retry_errors)
    elif cmd == "advance-completed":
        out = {"control_version": pipe.advance_completed()}
    elif cmd == "status":
        out = [r.asDict() for r in pipe.status(spark.createDataFrame([(u,) for u in args.urls], "url string")).orderBy("url", "iteration").collect()]
    else:
        out = [r.asDict() for r in pipe.progress().collect()]  # bounded: one row per (stage, status)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
