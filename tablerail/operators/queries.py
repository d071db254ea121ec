"""Read-side operators: aggregations, latest-per-key, ordering, loaders
(AGG1–AGG8, WIN1–WIN5, SRT1–SRT3, SRC4–SRC7).

Latest-row-per-key uses ``row_number() == 1``: Spark plans it as a partial
``WindowGroupLimit`` before the shuffle, so at most one row per key and map
partition is shuffled – a URL holding a third of the table costs one row per
partition, not a third of the table in one task."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.operators.predicates import active_gate, filter_predicate, ready_gate
from tablerail.session import EPOCH, ts

log = logging.getLogger(__name__)


# ---------------------------------------------------------------------------
# Ordering helpers
# ---------------------------------------------------------------------------

def _order(col: str | Column, desc: bool) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    # DuckDB puts NULLs last in both directions; say so explicitly for Spark.
    return c.desc_nulls_last() if desc else c.asc_nulls_last()


def top1_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group under ``order`` (a total order is the caller's job)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def group_ordinal(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "ordinal",
                  pieces: int | None = None) -> DataFrame:
    """``row_number() - 1`` inside each group under ``order`` (ascending, NULLs
    last, a total order), without putting a group into one task.

    A window partitioned by the group alone sorts a hot group in one task.
    Here each group is cut into at most ``pieces`` (default: the shuffle
    width) pieces by equal-width buckets of the first order column between
    its minimum and maximum (scalar subqueries, one aggregate), so a
    group holding a third of the table spreads over many tasks.  A piece is a
    pure function of the row's own values, so every branch of the plan (and
    every retry) agrees on it.  A row's ordinal is its rank inside its
    (group, piece) plus the sizes of the same group's earlier pieces: a
    running sum over a table of at most ``pieces`` rows per group.  The split
    is by value, so rows of one group that share (nearly) one value of the
    first order column stay in one piece; that window spills and finishes,
    it is just not split further."""
    spark = df.sparkSession
    n = int(pieces or spark.conf.get("spark.sql.shuffle.partitions"))
    first = F.col(order[0])
    if isinstance(df.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType)):
        # microseconds since the epoch: exact and free of time-zone folds
        first = F.timestamp_diff("MICROSECOND", ts(EPOCH), first)
    v = first.cast("double")
    # scalar subqueries (planned into the query, merged into one aggregate)
    lo, hi = df.agg(F.min(v)).scalar(), df.agg(F.max(v)).scalar()
    width = F.floor((v - lo) / (hi - lo) * n).cast("int")
    bucket = F.when(hi > lo, F.least(width, F.lit(n - 1))).otherwise(F.lit(0))
    bucket = F.when(v.isNull(), F.lit(n)).otherwise(bucket)  # NULLs sort last
    b = df.withColumn("_piece", bucket)
    rank = F.row_number().over(Window.partitionBy(*group, "_piece").orderBy(*[_order(c, False) for c in order])) - 1
    sizes = b.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_piece").alias("_p"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cond = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_piece") == F.col("_p")]
    j = b.withColumn("_rank", rank).join(offsets, cond, "inner")
    return j.withColumn(out, F.col("_off") + F.col("_rank")).drop(
        "_piece", "_rank", "_p", "_off", *[f"_g_{g}" for g in group])


def activity_key() -> Column:
    """DT4: latest-activity timestamp ``coalesce(updated_at, created_at, epoch)``."""
    return F.coalesce(F.col("updated_at").cast("timestamp_ntz"), F.col("created_at").cast("timestamp_ntz"),
                      ts(EPOCH))


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------

def progress_counts(control: DataFrame) -> DataFrame:
    """AGG1: rows per (stage, status), ordered."""
    return (control.groupBy("stage", "status").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("stage", "status"))


def url_progress(control: DataFrame) -> DataFrame:
    """AGG2: per-URL decision progress (the ``v_pipeline_progress`` view)."""
    t = F.col("transition_flag")
    fin = F.sum(t).cast("bigint")
    return control.groupBy("url").agg(
        fin.alias("finalized_steps"),
        F.sum(F.when(F.col("decision_flag") == 1, 1).otherwise(0)).cast("bigint").alias("ready_now"),
        F.count(F.lit(1)).alias("total_stages"),
        (fin == F.count(F.lit(1))).alias("is_final"),
    )


def max_iteration(control: DataFrame) -> DataFrame:
    """AGG3: highest iteration per URL (URLs absent from control get 0 at the join)."""
    return control.groupBy("url").agg(F.coalesce(F.max("iteration"), F.lit(0)).alias("max_iteration"))


def _norm(vals) -> list[str]:
    if vals is None:
        return []
    if isinstance(vals, str):
        vals = [vals]
    return [str(getattr(v, "value", v)).strip().upper() for v in vals]


def _distinct_urls(rows: DataFrame, order: list[Column], limit: int | None) -> DataFrame:
    g = rows.groupBy("url").agg(F.max("updated_at").alias("_u"), F.max("created_at").alias("_c"))
    if limit is None:
        # the full set: ordering only matters to a consumer that collects it
        return g.select("url")
    return g.orderBy(*order, F.col("url").asc()).limit(int(limit)).select("url")


def urls_by_filters(control: DataFrame, *, status=None, stage=None, active_only: bool = True,
                    limit: int | None = None) -> DataFrame:
    """AGG4a: distinct URLs by status/stage lists and the broad active gate,
    newest first (per URL: latest ``updated_at``), ``url`` as tiebreak."""
    pred = F.lit(True)
    st, sg = _norm(status), _norm(stage)
    if st:
        pred = pred & F.col("status").isin(st)
    if sg:
        pred = pred & F.col("stage").isin(sg)
    if active_only:
        pred = pred & active_gate()
    return _distinct_urls(control.where(pred), [_order("_u", True)], limit)


def urls_by_stage_and_status(control: DataFrame, stage: str, *, status=("NEW",), iteration: int | None = None,
                             ready_only: bool = True) -> DataFrame:
    """AGG4b: distinct URLs at ``stage`` with a status in the list, strict READY gate."""
    st = _norm(status)
    if not st:
        return control.select("url").where(F.lit(False))
    pred = (F.col("stage") == F.lit(str(stage).upper())) & F.col("status").isin(st)
    if ready_only:
        pred = pred & ready_gate()
    if iteration is not None:
        pred = pred & (F.col("iteration") == F.lit(int(iteration)))
    return _distinct_urls(control.where(pred), [_order("_u", True), _order("_c", True)], None)


def urls_by_status(control: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    """AGG4c: distinct URLs with one status; ordered by URL before an optional limit."""
    out = control.where(F.col("status") == F.lit(str(status).upper())).select("url").distinct()
    return out.orderBy("url").limit(int(limit)) if limit else out


def urls_by_stage(control: DataFrame, stage: str, limit: int | None = None) -> DataFrame:
    """AGG4d: distinct URLs at one stage."""
    out = control.where(F.col("stage") == F.lit(str(stage).upper())).select("url").distinct()
    return out.orderBy("url").limit(int(limit)) if limit else out


def registry_urls(url_table: DataFrame) -> DataFrame:
    """AGG4e: distinct URLs of the registry."""
    return url_table.select("url").distinct()


def pk_duplicates(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """AGG5: every member of each duplicate primary-key group.

    Keys are counted with map-side combining; members are found by a semi
    join (AQE splits a hot key's partition)."""
    missing = [k for k in pk if k not in df.columns]
    if missing:
        log.warning("primary-key columns missing: %s", missing)
        return df.where(F.lit(False))
    dup = df.groupBy(*pk).count().where(F.col("count") > 1).select(*pk)
    return df.join(dup, list(pk), "left_semi")


def first_per_pk(df: DataFrame, pk: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """AGG6: keep one row per key, the first under an explicit order
    (default: newest ``updated_at``, then ``created_at``)."""
    order = list(order) if order else [_order("updated_at", True), _order("created_at", True)]
    return top1_per_group(df, pk, order)


def exact_dedup(df: DataFrame) -> DataFrame:
    """AGG7: drop rows that are equal in every column."""
    return df.dropDuplicates()


GROUP_CHUNK = 1000


def group_by_url(control: DataFrame, columns: Sequence[str] | None = None, chunk: int = GROUP_CHUNK) -> DataFrame:
    """AGG8: the rows of each URL as ordered objects: url, part, n_rows, items.

    ``items`` is an array of structs with all columns (or ``columns``), in order
    of iteration.  A URL has one row per range of ``chunk`` iterations: part p
    holds iterations p * chunk to (p + 1) * chunk - 1, parts follow each other, and
    since (url, iteration) is the key none holds more than ``chunk`` items,
    however many iterations one URL has."""
    columns = list(columns or control.columns)
    item = F.struct(F.col("iteration").alias("_at"), F.struct(*columns).alias("row"))
    g = (control.withColumn("part", F.floor(F.col("iteration") / F.lit(chunk)).cast("bigint"))
         .groupBy("url", "part").agg(F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_list(item)).alias("items")))
    return g.select("url", "part", "n_rows", F.transform("items", lambda x: x["row"]).alias("items"))


# ---------------------------------------------------------------------------
# Latest-per-key
# ---------------------------------------------------------------------------

def latest_state(control: DataFrame, ready_only: bool = False) -> DataFrame:
    """WIN1: latest control row per URL by activity, then iteration (optionally READY rows only)."""
    rows = control.where(ready_gate()) if ready_only else control
    return top1_per_group(rows, ["url"], [activity_key().desc(), F.col("iteration").desc()])


def newest_page(web_page: DataFrame) -> DataFrame:
    """WIN2: newest ``web_page`` row per (url, iteration) by ``created_at``."""
    return top1_per_group(web_page, ["url", "iteration"],
                          [_order("created_at", True), _order("updated_at", True), _order("fetched_at", True)])


def highest_iteration(control: DataFrame) -> DataFrame:
    """WIN3: the highest-iteration row of each URL."""
    return top1_per_group(control, ["url"], [F.col("iteration").desc()])


def newest_by_updated(control: DataFrame) -> DataFrame:
    """WIN4: newest row per URL by ``updated_at DESC`` (NULLs last), iteration tiebreak."""
    return top1_per_group(control, ["url"], [_order("updated_at", True), F.col("iteration").desc()])


def prefer_latest_only(df: DataFrame, table: S.TableSpec | str) -> DataFrame:
    """WIN5: one row per primary key without ``iteration``: the highest iteration,
    then the configured order."""
    spec = S.table_spec(table)
    keys = [k for k in spec.primary_keys if k != "iteration"]
    order = [F.col("iteration").desc()] + [_order(c, d) for c, d in spec.order_by if c in df.columns]
    return top1_per_group(df, keys, order)


# ---------------------------------------------------------------------------
# Ordering and loaders
# ---------------------------------------------------------------------------

def recent(control: DataFrame, limit: int = 10) -> DataFrame:
    """SRT2: top-k most recently updated rows (url, stage, status, updated_at)."""
    return (control.orderBy(_order("updated_at", True), F.col("url"), F.col("iteration"))
            .limit(int(limit)).select("url", "stage", "status", "updated_at"))


def _parse_order(order_by) -> list[tuple[str, bool]]:
    if order_by is None:
        return []
    if isinstance(order_by, str):
        order_by = [t for t in order_by.split(",")]
    out = []
    for term in order_by:
        if isinstance(term, tuple):
            out.append((term[0], bool(term[1])))
            continue
        parts = str(term).split()
        if not parts:
            continue
        direction = parts[1].upper() if len(parts) > 1 else "ASC"
        if direction not in ("ASC", "DESC"):
            raise ValueError(f"bad sort direction: {term!r}")
        out.append((parts[0], direction == "DESC"))
    return out


def resolve_order(df: DataFrame, table: S.TableSpec | str, order_by=None) -> list[Column]:
    """SRT3: call argument, then table config; terms on unknown columns are
    dropped; if nothing is left: recency columns, else key columns other than
    ``url``, else ``*_key`` columns, all DESC NULLS LAST."""
    spec = S.table_spec(table)
    cols = set(df.columns)
    terms = [(c, d) for c, d in (_parse_order(order_by) or list(spec.order_by)) if c in cols]
    if not terms:
        fallback = [c for c in ("updated_at", "created_at") if c in cols]
        fallback = fallback or [k for k in spec.primary_keys if k != "url" and k in cols]
        fallback = fallback or [c for c in df.columns if c.endswith("_key")]
        terms = [(c, True) for c in fallback]
    return [_order(c, d) for c, d in terms]


def load_table(df: DataFrame, table: S.TableSpec | str, *, order_by=None, columns="*", **filters) -> DataFrame:
    """SRC4: filter (FLT3) → project → order (SRT3).  The filter reaches the
    parquet scan; only the selected columns are read.

    A table has no order of its own, so it is sorted only on request:
    ``order_by`` a list of terms, or ``"default"`` for the table's configured
    order (for a caller that shows or limits the rows)."""
    spec = S.table_spec(table)
    out = df.where(filter_predicate(spec, **filters))
    if order_by is not None:
        out = out.orderBy(*resolve_order(out, spec, None if order_by == "default" else order_by))
    if columns not in ("*", None):
        out = out.select(*([columns] if isinstance(columns, str) else list(columns)))
    return out


def select_for_urls(df: DataFrame, table: S.TableSpec | str, urls: DataFrame, columns: Sequence[str] | str = "*",
                    order_by=None) -> DataFrame:
    """SRC5 (bulk form): a stable projection for the URLs of ``urls``.
    Unknown columns or bad sort directions raise ``ValueError``."""
    spec = S.table_spec(table)
    cols = spec.columns if columns in ("*", None) else (
        [c.strip() for c in columns.split(",")] if isinstance(columns, str) else list(columns))
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    terms = _parse_order(order_by)
    bad = [c for c, _ in terms if c not in df.columns]
    if bad:
        raise ValueError(f"unknown order columns: {bad}")
    out = df.join(urls.select("url").distinct(), "url", "left_semi").select(*cols)
    return out.orderBy(*[_order(c, d) for c, d in terms]) if terms else out


def control_rows_for_urls(control: DataFrame, urls: DataFrame, latest_iteration_only: bool = False) -> DataFrame:
    """SRC6 (bulk form): control rows of the given URLs; optionally the highest iteration only."""
    # the highest iteration per URL is taken first (partial group limit), so a hot
    # URL's rows never meet in one task
    rows = highest_iteration(control) if latest_iteration_only else control
    return rows.join(urls.select("url").distinct(), "url", "left_semi")


def current_stage(control: DataFrame) -> DataFrame:
    """SRC7: current stage per URL (the latest row by activity)."""
    return latest_state(control).select("url", "stage")
