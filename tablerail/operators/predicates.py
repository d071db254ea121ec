"""Predicates, filters and validation reports (FLT*, VAL*)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.functions.text import has_visible_text
from tablerail.session import ts

log = logging.getLogger(__name__)


def _values(v) -> list:
    if v is None:
        return []
    if isinstance(v, (str, bytes)) or not isinstance(v, Iterable):
        return [v]
    return list(v)


def _upper(vals: Sequence) -> list[str]:
    # Statuses/stages are stored upper-case; enum-like strings match whatever case is passed.
    return [str(getattr(v, "value", v)).strip().upper() for v in vals]


def lease_free(now) -> Column:
    """Unclaimed, no lease, or lease expired (three-valued, as written)."""
    return (F.col("is_claimed") == F.lit(False)) | F.col("lease_until").isNull() | (F.col("lease_until") < ts(now))


def claimable(stage: str, statuses, now) -> Column:
    """FLT1: ``stage = s ∧ status IN (…) ∧ task_state = 'READY' ∧ lease free``.
    An empty status list matches nothing."""
    st = _upper(_values(statuses))
    if not st:
        return F.lit(False)
    return (
        (F.col("stage") == F.lit(str(stage).upper()))
        & F.col("status").isin(st)
        & (F.col("task_state") == F.lit("READY"))
        & lease_free(now)
    )


def has_text(col: str | Column = "clean_text") -> Column:
    """FLT2: text present and not blank (blank = only whitespace of the class)."""
    return has_visible_text(col)


def active_gate() -> Column:
    """FLT4: broad "active" – gate NULL or not SKIP/HOLD (PAUSED counts as active)."""
    return F.col("task_state").isNull() | ~F.col("task_state").isin("SKIP", "HOLD")


def ready_gate() -> Column:
    """FLT5: strict READY gate."""
    return F.col("task_state") == F.lit("READY")


def include_urls(df: DataFrame, urls: DataFrame | None) -> DataFrame:
    """FLT7: keep rows whose ``url`` is in ``urls`` (a one-column DataFrame).

    A user list has no known bound, so it is never broadcast by hint; the
    adaptive planner broadcasts what it has measured to be small."""
    if urls is None:
        return df
    return df.join(urls.select("url").distinct(), "url", "left_semi")


def filter_predicate(spec: S.TableSpec | str, **filters) -> Column:
    """FLT3: keyword filters → one predicate.

    Scalars are equality, sequences are IN lists, an empty list is FALSE,
    ``None`` values are dropped.  Keys outside the table's filter whitelist are
    ignored with a warning.  Stage/status/task_state values are upper-cased."""
    spec = S.table_spec(spec)
    allowed = set(spec.filter_columns)
    pred = F.lit(True)
    for key, val in filters.items():
        if val is None:
            continue
        if key not in allowed:
            log.warning("ignoring filter on %s.%s (not a filter column)", spec.name, key)
            continue
        is_list = not isinstance(val, (str, bytes)) and isinstance(val, Iterable)
        vals = list(val) if is_list else [val]
        if key in ("stage", "status", "task_state"):
            vals = _upper(vals)
        if is_list:
            pred = pred & (F.col(key).isin(vals) if vals else F.lit(False))
        else:
            pred = pred & (F.col(key) == F.lit(vals[0]))
    return pred


# ---------------------------------------------------------------------------
# Validation reports
# ---------------------------------------------------------------------------

def pk_duplicate_keys(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation: hot keys combine map-side)."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique_pk(df: DataFrame, pk: Sequence[str]) -> None:
    """VAL1: raise with (at most 20 of) the duplicate keys; reads only the key columns."""
    dupes = pk_duplicate_keys(df.select(*pk), pk).limit(20).collect()
    if dupes:
        raise ValueError(f"duplicate primary keys on {list(pk)}: {[tuple(r) for r in dupes]}")


def flag_violations(df: DataFrame) -> DataFrame:
    """VAL2: one row per (row, failed check) for the decision/transition flags."""
    d, t = F.col("decision_flag"), F.col("transition_flag")
    checks = [
        ("decision_flag_domain", d.isNull() | d.isin(0, 1)),
        ("transition_flag_domain", t.isin(0, 1)),
        ("not_both_set", ~((d == 1) & (t == 1))),
    ]
    # A CHECK passes unless it is FALSE (NULL passes, as in SQL).
    failed = F.array(*[F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in checks])
    return (df.withColumn("check_name", F.explode(F.filter(failed, lambda x: x.isNotNull())))
            .select("url", "iteration", "decision_flag", "transition_flag", "check_name"))


def enum_reason() -> Column:
    """VAL3: reason text for a control row whose enums are not members, else NULL."""
    return (F.when(~F.coalesce(F.col("stage").isin(*S.STAGES), F.lit(False)), F.lit("stage"))
            .when(~F.coalesce(F.col("status").isin(*S.STATUSES), F.lit(False)), F.lit("status"))
            .when(~F.coalesce(F.col("task_state").isin(*S.TASK_STATES), F.lit(False)), F.lit("task_state")))


def split_enum_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VAL3: (valid rows, rejected rows + ``reason``)."""
    tagged = df.withColumn("_reason", enum_reason())
    good = tagged.where(F.col("_reason").isNull()).drop("_reason")
    bad = tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad
