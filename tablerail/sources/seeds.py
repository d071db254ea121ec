"""Seed files (SRC1–SRC3, PRJ6): JSON lists of URLs into the ``url`` registry.

Accepted shapes per file: a JSON array of ``{url, source?, tags?}`` or an
object ``{"urls": [...]}``.  Many files are one read; mixed ``tags`` (list in
one file, CSV string in another) arrive as text and are normalised by STR3.
Files of any size are read in byte ranges (``json_split``); their entries are
parsed to VARIANT, so one bad file or entry is known by its name and place and
hides no other."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.functions.text import join_tags, normalize_tags, strip_ws
from tablerail.operators.upsert import upsert
from tablerail.sources import json_split

log = logging.getLogger(__name__)


def _matched(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything (one file system call)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def seed_items(raw: DataFrame) -> DataFrame:
    """Entries of seed files (``raw``: ``json_split.records``): file, pos, url, source,
    tags and ``reason`` (NULL for a good entry).  A file that is no JSON, or of
    another shape, is one row with a reason; so is each entry without a usable url."""
    def text_of(name: str):
        return F.try_variant_get("item", f"$.{name}", "string")

    entry_kind = F.regexp_extract(F.schema_of_variant("item"), "^([A-Z]+)", 1)
    url_kind = F.regexp_extract(F.schema_of_variant(F.try_variant_get("item", "$.url", "variant")), "^([A-Z]+)", 1)
    reason = (F.when(F.col("reason").isNotNull(), F.col("reason"))
              .when(F.coalesce(entry_kind, F.lit("")) != "OBJECT", F.lit("entry is not an object"))
              .when((F.coalesce(url_kind, F.lit("")) != "STRING") | (F.coalesce(strip_ws(text_of("url")), F.lit("")) == ""),
                    F.lit("url is missing or blank")))
    listed_tags = F.to_json(F.try_variant_get("item", "$.tags", "array<string>"))
    return json_split.elements(raw).select("file", "pos", text_of("url").alias("url"), text_of("source").alias("source"),
                                           F.coalesce(listed_tags, text_of("tags")).alias("tags"), reason.alias("reason"))


def _items_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The entries of seed files; a file without a byte has none and is no row."""
    return seed_items(json_split.records(spark.read, paths))


def read_seed_entries(spark: SparkSession, paths: str | list[str], bad: str = "raise") -> DataFrame:
    """SRC1 + PRJ6: seed entries ``(url, source, tags)`` from one or many JSON files.

    ``tags`` is text (CSV or a JSON array).  A bad file or entry raises when the
    rows are computed; with ``bad="skip"`` it is left to ``seed_rejects``."""
    if bad not in ("raise", "skip"):
        raise ValueError(f"unknown mode: {bad!r}")
    items = _items_of(spark, paths)
    if bad == "skip":
        items = items.where(F.col("reason").isNull())
    else:
        # part of the url itself, so that no projection can drop the check
        items = items.withColumn("url", F.when(F.col("reason").isNull(), F.col("url")).otherwise(F.raise_error(
            F.concat(F.lit("bad seed in "), F.col("file"), F.lit(": "), F.col("reason")))))
    return items.select("url", "source", "tags")


def seed_rejects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files and entries that are no seeds: file, pos (NULL: the whole file), reason."""
    return _items_of(spark, paths).where(F.col("reason").isNotNull()).select("file", "pos", "reason")


def read_typed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC2: JSON with a declared schema; an invalid record fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def flatten_seeds(entries: DataFrame) -> DataFrame:
    """PRJ6: ``(url, source, tags)`` rows of the registry: URL trimmed (Q24), tags
    normalised (STR3) and comma-joined (STR4), empty → NULL."""
    tags = normalize_tags(F.col("tags"), entries.schema["tags"].dataType)
    return entries.select(strip_ws("url").alias("url"), "source", join_tags(tags).alias("tags"))


def ingest_seed_files(spark: SparkSession, paths: str | list[str], url_table: DataFrame, now,
                      policy: str = "pk_scoped", bad: str = "raise") -> DataFrame:
    """SRC3: seed files → registry upsert.  Missing paths are skipped with a
    warning; bad files and entries raise (or are skipped, see ``seed_rejects``); a
    URL listed twice with different source or tags raises."""
    plist = [paths] if isinstance(paths, str) else list(paths)
    present = [p for p in plist if _matched(spark, p)]
    for p in plist:
        if p not in present:
            log.warning("seed file not found, skipped: %s", p)
    if not present:
        return url_table
    # as one upsert batch: identical entries collapse, the same URL with
    # different source/tags is a primary-key conflict and raises (VAL1)
    rows = flatten_seeds(read_seed_entries(spark, present, bad))
    return upsert(url_table, rows, S.URL, now, policy=policy)
