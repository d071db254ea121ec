"""Helpers for checking Spark results against a DuckDB oracle."""

from __future__ import annotations

import datetime as _dt
import json
import math
import re

import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_for(sf_dir: str):
    """An in-process DuckDB connection with the driver's tables as views."""
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
        except Exception:  # noqa: BLE001 - a missing table only matters to queries that use it
            pass
    return con


def _canon(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 9))
    if isinstance(v, (pd.Timestamp, _dt.datetime)):
        if pd.isna(v):
            return "∅"
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, _dt.date):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, bool):
        return "true" if v else "false"
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _canon(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return "[" + ",".join(_canon(x) for x in list(v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in v.items()) + "}"
    if v is pd.NaT or (isinstance(v, type(pd.NA)) and v is pd.NA):
        return "∅"
    return str(v)


def canonical_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_canon(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows)


def compare_frames(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    """Order-insensitive comparison: column names, row count, values."""
    a, b = sorted(spark_pdf.columns), sorted(oracle_pdf.columns)
    if a != b:
        return False, f"columns differ: spark={a} oracle={b}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"row count spark={len(spark_pdf)} oracle={len(oracle_pdf)}"
    ra, rb = canonical_rows(spark_pdf), canonical_rows(oracle_pdf)
    if ra != rb:
        diff = [(x, y) for x, y in zip(ra, rb) if x != y][:2]
        return False, f"values differ, first: {diff}"
    return True, "match"


class OfflineClient:
    """Deterministic stand-in for a model, for tests and the registered runs (no
    network there): answers the JSON summary prompt from the whole page text it
    contains (first sentence as title, all others as bullets)."""

    rate_per_minute = None  # local, no provider quota
    _content = re.compile(r"CONTENT:\n(.*?)\n\n(?:Output Format:|Instructions:|Output:)", re.S)
    _sentence = re.compile(r"[^.!?]+[.!?]?")

    def __init__(self, provider: str = "openai", model_id: str = "offline"):
        self.provider, self.model_id = provider, model_id

    def complete(self, system: str, prompt: str, temperature: float, max_tokens: int) -> str:
        m = self._content.search(prompt)
        text = m.group(1) if m else prompt
        sents = [s.strip() for s in self._sentence.findall(text) if s.strip()]
        if not sents:
            return "I could not find any content to summarise."
        body = {"title": sents[0], "bullets": sents[1:] or sents[:1]}
        if len(sents) > 4:
            body["key_points"] = [max(sents, key=len)]
        return json.dumps(body, ensure_ascii=False)
