"""Cell coercion of control rows (CO1–CO10) and date helpers (DT2–DT4), as
column expressions: the row model's validators re-expressed for whole columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.functions.text import strip_ws
from tablerail.session import ts

# Accepted spellings of a boolean flag.
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")
# Date formats tried after ISO, in order (Python strptime: %Y-%m-%d, %b %d, %Y, %B %d, %Y).
DATE_FORMATS = ("yyyy-MM-dd", "MMM d, yyyy", "MMMM d, yyyy")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _as_text(c: Column) -> Column:
    return c.cast("string")


def coerce_iteration(col) -> Column:
    """CO1: NULL → 0; ``int(float(v))`` (truncating); unparsable, NaN, ±inf, out of range → 0."""
    c = _c(col)
    as_double = strip_ws(_as_text(c)).try_cast("double")
    return F.coalesce(as_double.try_cast("int"), F.lit(0))


def coerce_stage(col) -> Column:
    """CO2: trim + upper (membership is checked by VAL3; NULL stays NULL = reject)."""
    return F.upper(strip_ws(_as_text(_c(col))))


def coerce_status(col) -> Column:
    """CO3: NULL → NEW; trim + upper."""
    c = _c(col)
    return F.when(c.isNull(), F.lit("NEW")).otherwise(F.upper(strip_ws(_as_text(c))))


def coerce_task_state(col, status: Column) -> Column:
    """CO4: blank → HOLD when status is COMPLETED/SKIPPED, else READY; legacy
    spellings mapped; result checked by VAL3."""
    c = _c(col)
    s = F.upper(strip_ws(_as_text(c)))
    blank = c.isNull() | (s == "")
    mapped = s
    for old, new in S.LEGACY_TASK_STATE.items():
        mapped = F.when(s == old, F.lit(new)).otherwise(mapped)
    return (F.when(blank & F.coalesce(status.isin("COMPLETED", "SKIPPED"), F.lit(False)), F.lit("HOLD"))
            .when(blank, F.lit("READY"))
            .otherwise(mapped))


def coerce_claimed(col, dtype: T.DataType | None = None) -> Column:
    """CO5: yes/no words, else an integer ≠ 0, else false; NULL → false."""
    c = _c(col)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    s = F.lower(strip_ws(_as_text(c)))
    is_int = s.rlike(r"^[+-]?[0-9]+$")
    return (F.when(c.isNull(), F.lit(False))
            .when(s.isin(*TRUE_WORDS), F.lit(True))
            .when(s.isin(*FALSE_WORDS), F.lit(False))
            .when(is_int, F.regexp_replace(s, r"^[+-]?0*", "") != "")
            .otherwise(F.lit(False)))


def coerce_timestamp(col) -> Column:
    """CO6: NULL, blank or unparsable → NULL."""
    c = _c(col)
    return F.when(strip_ws(_as_text(c)) == "", F.lit(None).cast("timestamp_ntz")).otherwise(
        strip_ws(_as_text(c)).try_cast("timestamp_ntz"))


def coerce_worker(col) -> Column:
    """CO7: trim; blank → NULL."""
    return F.nullif(strip_ws(_as_text(_c(col))), F.lit(""))


def coerce_url(col) -> Column:
    """CO8: trimmed, otherwise verbatim (no host or slash normalisation)."""
    return strip_ws(_as_text(_c(col)))


def strip_strings(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """CO9: strip whitespace in every string column."""
    return df.withColumns({f.name: strip_ws(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType) and f.name not in exclude})


def clean_control(raw: DataFrame, now) -> DataFrame:
    """CO10: whole-row control clean-up.  Returns the control columns plus
    ``reject_reason`` (NULL when the row is valid; else the first failing field)."""
    cols = set(raw.columns)
    types = {f.name: f.dataType for f in raw.schema.fields}

    def get(name):
        return F.col(name) if name in cols else F.lit(None)

    status = coerce_status(get("status"))
    url = coerce_url(get("url"))
    stage = coerce_stage(get("stage"))
    gate = coerce_task_state(get("task_state"), status)
    out = raw.select(
        url.alias("url"),
        coerce_iteration(get("iteration")).alias("iteration"),
        stage.alias("stage"),
        status.alias("status"),
        gate.alias("task_state"),
        coerce_claimed(get("is_claimed"), types.get("is_claimed")).alias("is_claimed"),
        coerce_worker(get("worker_id")).alias("worker_id"),
        coerce_timestamp(get("lease_until")).alias("lease_until"),
        F.nullif(strip_ws(_as_text(get("source_file"))), F.lit(None)).alias("source_file"),
        strip_ws(_as_text(get("notes"))).alias("notes"),
        F.coalesce(coerce_timestamp(get("created_at")), ts(now)).alias("created_at"),
        coerce_timestamp(get("updated_at")).alias("updated_at"),
    )
    reason = (F.when(F.col("url").isNull(), F.lit("url"))
              .when(~F.coalesce(F.col("stage").isin(*S.STAGES), F.lit(False)), F.lit("stage"))
              .when(~F.coalesce(F.col("status").isin(*S.STATUSES), F.lit(False)), F.lit("status"))
              .when(~F.coalesce(F.col("task_state").isin(*S.TASK_STATES), F.lit(False)), F.lit("task_state")))
    return out.withColumn("reject_reason", reason)


def created_at_or_now(col, now) -> Column:
    """DT2: tolerant timestamp cast, NULL → now."""
    return F.coalesce(_as_text(_c(col)).try_cast("timestamp_ntz"), ts(now))


def parse_date(col) -> Column:
    """DT3: ISO date, then the fixed formats; unparsable → NULL."""
    s = strip_ws(_as_text(_c(col)))
    iso = F.when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), s.try_cast("date"))
    return F.coalesce(iso, *[F.try_to_date(s, f) for f in DATE_FORMATS])
