"""Projections: schema alignment, stamping, metadata, decision view (PRJ1–PRJ7)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.functions.text import cell_text
from tablerail.session import ts

log = logging.getLogger(__name__)


def align(df: DataFrame, target: S.TableSpec | str | Sequence[str], strict: bool = False,
          dedup: bool = True) -> DataFrame:
    """PRJ1: drop extra columns, add missing ones with the table's default, else
    NULL (``strict`` → error), reorder, nested values → JSON text, NaN → NULL, drop exact duplicate rows.

    With a ``TableSpec`` every column is also cast to its declared type."""
    spec = None
    if isinstance(target, (S.TableSpec, str)):
        spec = S.table_spec(target)
        columns = spec.columns
    else:
        columns = list(target)
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in columns if c not in present]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    extra = [c for c in present if c not in columns]
    if extra:
        log.warning("dropping unexpected columns: %s", extra)
    out = []
    for c in columns:
        want = spec.dtype(c) if spec is not None else None
        if c not in present:
            value = spec.defaults.get(c) if spec is not None else None
            out.append(F.lit(value).cast(want or T.StringType()).alias(c))
            continue
        have = present[c]
        col = F.col(c)
        if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
            col = cell_text(col, have)
            have = T.StringType()
        if isinstance(have, (T.FloatType, T.DoubleType)):
            col = F.when(~F.isnan(col), col)
        if want is not None and want != have:
            col = col.try_cast(want) if hasattr(col, "try_cast") else col.cast(want)
        out.append(col.alias(c))
    res = df.select(*out)
    return res.dropDuplicates() if dedup else res


def align_strict(df: DataFrame, table: S.TableSpec | str) -> DataFrame:
    """PRJ2: alignment for a registered table, missing columns are an error."""
    return align(df, table, strict=True)


# Column stamping policies: column → 'now' | 'default' | 'param' | 'none'.
DEFAULT_STAMP_POLICY = {"created_at": "now", "updated_at": "now"}
LLM_DEFAULTS = {"llm_provider": S.DEFAULT_PROVIDER, "model_id": None}


def stamp(df: DataFrame, table: S.TableSpec | str, now, policy: dict | None = None,
          params: dict | None = None) -> DataFrame:
    """PRJ4: fill only NULL cells per policy; one ``now`` for the whole batch."""
    spec = S.table_spec(table)
    policy = DEFAULT_STAMP_POLICY if policy is None else policy
    params = params or {}
    cols = set(df.columns)
    out = df
    for col, mode in policy.items():
        if col not in spec.columns:
            continue
        value: Column | None = None
        if mode == "now":
            value = ts(now)
        elif mode == "default" and col in LLM_DEFAULTS:
            v = params.get(col) or LLM_DEFAULTS.get(col)
            value = None if v is None else F.lit(v)
        elif mode == "param":
            v = params.get(col)
            value = None if v is None else F.lit(v)
        if value is None:
            continue
        cur = F.col(col) if col in cols else F.lit(None)
        out = out.withColumn(col, F.coalesce(cur.cast(spec.dtype(col)), value.cast(spec.dtype(col))))
    return out


def stamp_iteration(df: DataFrame, mode: str = "none", value: int | None = None,
                    control: DataFrame | None = None) -> DataFrame:
    """PRJ5: fill NULL iterations.

    ``param``/``constant`` need ``value``; ``pipeline_control`` takes the URL's
    highest iteration in ``control`` (0 when absent); ``none`` leaves it."""
    mode = (mode or "none").lower()
    if mode == "none" or "iteration" not in df.columns:
        return df
    if mode in ("param", "constant"):
        if value is None:
            raise ValueError(f"iteration stamping '{mode}' needs a value")
        return df.withColumn("iteration", F.coalesce(F.col("iteration"), F.lit(int(value))))
    if mode == "pipeline_control":
        if control is None:
            raise ValueError("iteration stamping 'pipeline_control' needs the control table")
        from tablerail.operators.queries import max_iteration
        mx = max_iteration(control).withColumnRenamed("max_iteration", "_max_it")
        return (df.join(mx, "url", "left")
                .withColumn("iteration", F.coalesce(F.col("iteration"), F.col("_max_it"), F.lit(0)))
                .drop("_max_it"))
    raise ValueError(f"unknown iteration mode: {mode}")


def add_metadata(df: DataFrame, table: S.TableSpec | str, *, source_file: str | None = None,
                 iteration: int | None = None, llm_provider: str | None = None,
                 model_id: str | None = None) -> DataFrame:
    """PRJ7: add metadata columns the table owns and ``df`` lacks; never overwrite."""
    spec = S.table_spec(table)
    values = {"source_file": source_file, "iteration": 0 if iteration is None else iteration,
              "llm_provider": llm_provider, "model_id": model_id}
    out = df
    for col, v in values.items():
        if col in spec.columns and col not in df.columns and v is not None:
            out = out.withColumn(col, F.lit(v).cast(spec.dtype(col)))
    return out


def decision_state(control: DataFrame) -> DataFrame:
    """PRJ3: ``ready`` / ``final`` / ``undecided`` from the decision flags."""
    d, t = F.col("decision_flag"), F.col("transition_flag")
    state = F.when((d == 1) & (t == 0), "ready").when(t == 1, "final").otherwise("undecided")
    return control.select("url", "stage", "decision_flag", "transition_flag", state.alias("decision_state"))
