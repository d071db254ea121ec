"""Table specifications, enumerations and the stage rail.

Every table is a DataFrame with a fixed ``StructType``; the primary key is not
enforced by Spark, so the operators in :mod:`tablerail.operators` keep it unique
(upserts are keyed, duplicate reports exist for checks).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Stage rail, in order.
STAGES: tuple[str, ...] = ("URL", "WEB_PAGE", "WEB_SUMMARY", "DONE")
# Machine status.
STATUSES: tuple[str, ...] = ("NEW", "IN_PROGRESS", "COMPLETED", "ERROR", "SKIPPED")
# Human gate.
TASK_STATES: tuple[str, ...] = ("READY", "PAUSED", "SKIP", "HOLD")
# Model providers (only the first two have callable clients).
PROVIDERS: tuple[str, ...] = ("openai", "anthropic", "mistral", "llama")
DEFAULT_PROVIDER = "openai"
# Legacy task-state spellings and what they mean now.
LEGACY_TASK_STATE = {
    "DONE": "HOLD",
    "COMPLETED": "HOLD",
    "SKIPPED": "SKIP",
    "RUNNING": "READY",
    "RETRY": "READY",
    "ABANDONED": "READY",
}
# Gates that a persist never overrides.
STICKY_GATES: tuple[str, ...] = ("SKIP", "PAUSED", "HOLD")
# Failure marker written for a page that could not be fetched.
FETCH_FAILED = "FETCH_FAILED"
# Lease lengths in minutes: claim default, URL runner, page and summary runners.
LEASE_DEFAULT_MIN = 15
LEASE_URL_RUNNER_MIN = 5
LEASE_STAGE_RUNNER_MIN = 10

FINAL_STAGE = STAGES[-1]
NEXT_STAGE = {s: (STAGES[i + 1] if i + 1 < len(STAGES) else None) for i, s in enumerate(STAGES)}
PREV_STAGE = {s: (STAGES[i - 1] if i > 0 else None) for i, s in enumerate(STAGES)}


@dataclass(frozen=True)
class TableSpec:
    """Schema, primary key and authoritative column order of one table."""

    name: str
    schema: T.StructType
    primary_keys: tuple[str, ...]
    # Columns a loader may filter on (primary key ∪ metadata) ∩ configured list.
    filter_columns: tuple[str, ...] = ()
    # Default loader order: (column, descending) pairs.
    order_by: tuple[tuple[str, bool], ...] = (("updated_at", True), ("created_at", True))
    # Column defaults applied by alignment when a column is missing.
    defaults: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def dtype(self, column: str) -> T.DataType:
        return self.schema[column].dataType

    @property
    def non_key_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.primary_keys]


_S, _I, _B, _TS = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


URL = TableSpec(
    name="url",
    schema=_struct(("url", _S), ("source", _S), ("tags", _S), ("created_at", _TS), ("updated_at", _TS)),
    primary_keys=("url",),
    filter_columns=("url", "source", "created_at", "updated_at"),
)

PIPELINE_CONTROL = TableSpec(
    name="pipeline_control",
    schema=_struct(
        ("url", _S), ("iteration", _I), ("stage", _S), ("status", _S), ("task_state", _S),
        ("is_claimed", _B), ("worker_id", _S), ("lease_until", _TS), ("source_file", _S),
        ("notes", _S), ("created_at", _TS), ("updated_at", _TS),
    ),
    primary_keys=("url", "iteration"),
    filter_columns=("url", "iteration", "stage", "status", "task_state"),
    order_by=(("updated_at", True),),
    defaults={"iteration": 0, "status": "NEW", "task_state": "READY", "is_claimed": False},
)

# Optional decision columns of the control table (decision views, VAL2).
CONTROL_DECISION_FIELDS = (
    T.StructField("decision_flag", T.ByteType(), True),
    T.StructField("transition_flag", T.ByteType(), True),
)

WEB_PAGE = TableSpec(
    name="web_page",
    schema=_struct(
        ("url", _S), ("iteration", _I), ("status_code", _I), ("html", _S), ("clean_text", _S),
        ("fetched_at", _TS), ("fetch_error", _S), ("created_at", _TS), ("updated_at", _TS),
    ),
    primary_keys=("url", "iteration"),
    filter_columns=("url", "iteration", "created_at", "updated_at"),
    defaults={"iteration": 0},
)

WEB_SUMMARY = TableSpec(
    name="web_summary",
    schema=_struct(
        ("url", _S), ("iteration", _I), ("llm_provider", _S), ("model_id", _S),
        ("summary_text", _S), ("summary_json", _S), ("tokens_prompt", _I),
        ("tokens_completion", _I), ("tokens_total", _I), ("created_at", _TS), ("updated_at", _TS),
    ),
    primary_keys=("url", "iteration", "llm_provider", "model_id"),
    filter_columns=("url", "iteration", "llm_provider", "model_id", "created_at", "updated_at"),
    defaults={"iteration": 0, "llm_provider": DEFAULT_PROVIDER},
)

REGISTRY: dict[str, TableSpec] = {t.name: t for t in (URL, PIPELINE_CONTROL, WEB_PAGE, WEB_SUMMARY)}

# Metadata columns a table may own (``add_metadata`` only adds these).
METADATA_COLUMNS = (
    "source_file", "iteration", "created_at", "updated_at", "llm_provider", "model_id",
    "stage", "status", "task_state",
)


def table_spec(name_or_spec) -> TableSpec:
    """Look up a table by name; unknown names raise ``ValueError``."""
    if isinstance(name_or_spec, TableSpec):
        return name_or_spec
    try:
        return REGISTRY[str(name_or_spec)]
    except KeyError:
        raise ValueError(f"unknown table: {name_or_spec!r}") from None
