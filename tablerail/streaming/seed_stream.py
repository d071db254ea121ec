"""Incremental seed ingest (STM1): new seed files in a folder are picked up by a
Structured Streaming file source and upserted into the stored ``url`` table.

A *load* is everything one run finds, in however many micro-batches.  Each batch
puts its entries into a pending table beside the store; when the run has seen all
files, the load is judged as a whole and applied in one keyed write.  So what is
a conflict (a URL listed twice with different values) does not depend on where
micro-batches end.  A later load may change a URL: that is an update.

Failures: the pending entries of a run that died belong to the next run's load; a
replayed batch overwrites its own folder; the number of the last batch applied is
noted in the same commit as the table, so no batch is applied twice.  Bad files
and entries, and conflicting URLs, go to a reject table instead of stopping the
stream or vanishing."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.operators.upsert import upsert
from tablerail.sources import json_split
from tablerail.sources.seeds import flatten_seeds, seed_items
from tablerail.sources.store import TableStore, release_materialized

_ENTRY = T.StructType([T.StructField("url", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("tags", T.StringType())])
# A seed file is an array of entries (read as rows) or a {"urls": [...]} object.
SEED_FILE_SCHEMA = T.StructType(list(_ENTRY.fields) + [T.StructField("urls", T.ArrayType(_ENTRY))])
REJECTS = "file string, pos long, url string, reason string"
ITEMS = "file string, pos long, url string, source string, tags string, reason string"


def _entries(batch: DataFrame) -> DataFrame:
    wrapped = batch.where(F.col("urls").isNotNull()).select(F.explode("urls").alias("e")).select("e.*")
    flat = batch.where(F.col("url").isNotNull()).select("url", "source", "tags")
    return flat.unionByName(wrapped)


def split_conflicts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to apply, conflicting URLs): equal rows collapse, a URL with
    different rows is applied not at all."""
    values = F.struct("source", "tags")
    g = rows.groupBy("url").agg(F.min(values).alias("least"), F.max(values).alias("most"))
    same = F.col("least") == F.col("most")
    return g.where(same).select("url", "least.source", "least.tags"), g.where(~same).select("url")


def rejects_path(store_root: str) -> str:
    return f"{store_root.rstrip('/')}/_seed_rejects"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's id, kept in its checkpoint: batch numbers belong to it."""
    return json.loads(spark.read.option("wholetext", True).text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _batches(spark: SparkSession, folder: str) -> list[int]:
    p, fs = _file_system(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName().removeprefix("batch=")) for st in fs.listStatus(p)
                  if st.getPath().getName().startswith("batch="))


def apply_load(spark: SparkSession, store: TableStore, pending: str, mark: str, now) -> int:
    """Judge the pending batches together and apply them; returns their number.

    ``mark`` names the stream in the table's manifest; batches up to the number
    noted there are in the table already and only cleared away."""
    applied = store.marks("url").get(mark, -1)
    found = _batches(spark, pending)
    load = [b for b in found if b > applied]
    if load:
        items = spark.read.schema(ITEMS).parquet(*[f"{pending}/batch={b}" for b in load])
        good, conflicts = split_conflicts(flatten_seeds(items.where("reason IS NULL").select("url", "source", "tags")))
        bad = items.where("reason IS NOT NULL").select("file", "pos", "url", "reason").unionByName(
            conflicts.select("url", F.lit("conflicting entries for one url").alias("reason")), allowMissingColumns=True)
        # the same folder again if the run dies before the table is written
        bad.write.mode("overwrite").parquet(f"{rejects_path(store.root)}/load={mark}-{load[0]}")
        store.upsert("url", good, lambda existing, rows: upsert(existing, rows, S.URL, now), marks={mark: load[-1]})
    for b in found:
        p, fs = _file_system(spark, f"{pending}/batch={b}")
        fs.delete(p, True)
    return len(load)


def run_seed_stream(spark: SparkSession, source_dir: str, store_root: str, checkpoint: str, now,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Process every seed file present now (``availableNow``) as one load and return
    the registry table; rejects are at ``rejects_path(store_root)``, a folder a load."""
    store = TableStore(spark, store_root)
    store.bootstrap(["url"])
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def pending() -> str:
        return f"{store.root}/_seed_pending/{_query_id(spark, checkpoint)}"

    def collect(batch: DataFrame, epoch_id: int) -> None:
        seed_items(batch).write.mode("overwrite").parquet(f"{pending()}/batch={epoch_id}")
        release_materialized(spark)

    q = (json_split.records(reader, source_dir).writeStream.foreachBatch(collect).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    apply_load(spark, store, pending(), _query_id(spark, checkpoint), now)
    return store.read("url")


def read_rejects(spark: SparkSession, store_root: str) -> DataFrame:
    """What the stream refused so far."""
    return spark.read.schema(REJECTS).parquet(f"{rejects_path(store_root)}/load=*")
