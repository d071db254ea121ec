"""Session helpers: building a session, explicit clock literals, the shared
checkpoint folder."""

from __future__ import annotations

import datetime as _dt
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed clock used by tests and registered queries (FIXTURES.md conventions).
TEST_NOW = "2024-01-15 00:00:00"
TEST_WORKER = "w-test"

EPOCH = "1970-01-01 00:00:00"


def build_session(master: str | None = None, app: str = "tablerail", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every operator assumes.

    AQE is on so joins against bounded key sets turn into broadcast joins only
    when the measured shuffle size allows it, and skewed partitions are split.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # fetch and model calls have side effects: never run them twice on purpose
        "spark.speculation": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ts(value) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone.

    Accepts a string, a ``datetime`` or a Column (returned as is)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def utc_now_str() -> str:
    """Current UTC time as text; callers capture it once per run."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S.%f")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for lineage cuts.

    Read from ``spark.checkpoint.dir``; only when it is unset is ``fallback`` set
    on the context (Spark makes the folder, on whatever file system it is).  A
    session inside one process may do without both: it gets a temporary folder."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    if fallback is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        fallback = tempfile.mkdtemp(prefix="tablerail-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy row work (regex cleaning, JSON checks) at least one
    partition per core.

    Meant for a file scan: a few large files with one row group each are read
    by one task apiece.  A scan with enough splits (any table at cluster scale)
    is returned unchanged, so no shuffle is added there; otherwise the rows are
    dealt round-robin over ``min_partitions`` (default: the cluster's
    parallelism).  Filters and projections above still reach the scan."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
