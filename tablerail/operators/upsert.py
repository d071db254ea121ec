"""Keyed writes as set operations (UPS1–UPS4, JN1–JN4).

A table is immutable data; an "upsert" returns the next version of the table.
There is one plan per write, whatever the sizes: the batch is exchanged once on
its whole primary key; in that grouping equal rows collapse, rows that share a
key but differ raise, and keys with a NULL raise; the join with the table on the
same key follows without another exchange of the batch.  Hashing every key
column spreads one URL with many iterations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail import schemas as S
from tablerail.operators.align import align, stamp
from tablerail.session import ts

POLICIES = ("pk_scoped", "full_replace", "none", "replace_by_pk")


def _shown(pk: Sequence[str]):
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in pk])


def row_digest(columns: Sequence[str]) -> tuple:
    """128 bits of a row's values as two longs; which values are NULL counts."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns]) if columns else F.lit("")
    return F.xxhash64(F.lit(1), nulls, *columns), F.xxhash64(F.lit(2), *reversed(columns), nulls)


def one_row_per_key(batch: DataFrame, pk: Sequence[str]) -> DataFrame:
    """``batch`` with one row per key (one exchange, on the key).

    Equal rows collapse; a key with different rows, or with a NULL in it (also
    one that could not be cast), raises when the plan runs.  Digests of 128 bits
    decide what is equal, so each row passes the exchange once."""
    rest = [c for c in batch.columns if c not in pk]
    values = F.struct(*rest) if rest else F.lit(True)
    low, high = row_digest(rest)
    d = batch.select(*pk, values.alias("_row"), low.alias("_low"), high.alias("_high"))
    g = d.groupBy(*pk).agg(F.first("_row").alias("_row"), *[f(c).alias(f"{c}{n}") for c in ("_low", "_high") for n, f in enumerate((F.min, F.max))])
    null_key = F.lit(False)
    for k in pk:
        null_key = null_key | F.col(k).isNull()
    equal = (F.col("_low0") == F.col("_low1")) & (F.col("_high0") == F.col("_high1"))
    one = (F.when(null_key, F.raise_error(F.concat(F.lit("NULL in primary key: "), _shown(pk))))
           .when(equal, F.col("_row"))
           .otherwise(F.raise_error(F.concat(F.lit("duplicate primary keys with different rows: "), _shown(pk)))))
    out = g.select(*pk, one.alias("_one"))
    return out.select(*[F.col(c) if c in pk else F.col("_one")[c].alias(c) for c in batch.columns])


def key_rejects(incoming: DataFrame, table: S.TableSpec | str) -> DataFrame:
    """Rows of a raw batch that no upsert accepts: ``reason`` names the key
    column that is NULL, or holds text that is not of the column's type."""
    spec = S.table_spec(table)
    have = set(incoming.columns)
    reason = F.lit(None).cast("string")
    for k in reversed([k for k in spec.primary_keys if k in have]):
        reason = (F.when(F.col(k).isNull(), F.lit(f"{k} is NULL"))
                  .when(F.col(k).try_cast(spec.dtype(k)).isNull(), F.lit(f"{k} is not a {spec.dtype(k).simpleString()}"))
                  .otherwise(reason))
    return incoming.withColumn("reason", reason).where(F.col("reason").isNotNull())


def prepare_batch(incoming: DataFrame, table: S.TableSpec | str, now, *, stamp_policy: dict | None = None,
                  params: dict | None = None) -> DataFrame:
    """Stamp → align → one row per primary key (see ``one_row_per_key``)."""
    spec = S.table_spec(table)
    batch = align(stamp(incoming, spec, now, stamp_policy, params), spec, dedup=not spec.primary_keys)
    return one_row_per_key(batch, spec.primary_keys) if spec.primary_keys else batch


def upsert(existing: DataFrame, incoming: DataFrame, table: S.TableSpec | str, now, *, policy: str = "pk_scoped",
           stamp_policy: dict | None = None, params: dict | None = None) -> DataFrame:
    """Apply ``incoming`` to ``existing`` under a dedup policy and return the new table.

    UPS1 ``pk_scoped``: matched keys get every non-key column from the batch
    (NULL included) except ``created_at``; ``updated_at = now``.  New keys keep
    their ``created_at`` (``now`` when NULL), ``updated_at = now``.
    UPS2 ``full_replace``: the batch is the table.
    UPS3 ``none``: insert only keys not present.
    UPS4 ``replace_by_pk``: delete matching keys, insert the batch as stamped.
    """
    spec = S.table_spec(table)
    if policy not in POLICIES:
        raise ValueError(f"unknown dedup policy: {policy!r}")
    batch = prepare_batch(incoming, spec, now, stamp_policy=stamp_policy, params=params)
    existing = existing.select(*spec.columns)
    pk = list(spec.primary_keys)
    if policy == "full_replace":
        return batch
    if policy == "none":
        return existing.unionByName(insert_only_new(existing, batch, pk))
    if policy == "replace_by_pk":
        return delete_matching(existing, batch, pk).unionByName(batch)
    return _upsert_full_outer(existing, batch, spec, now)


def _upsert_full_outer(existing: DataFrame, batch: DataFrame, spec: S.TableSpec, now) -> DataFrame:
    pk = list(spec.primary_keys)
    e = existing.withColumn("_old", F.lit(True)).alias("o")
    b = batch.withColumn("_new", F.lit(True)).alias("n")
    cond = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in pk]
    j = e.join(b, cond, "full_outer")
    has_new = F.col("n._new").isNotNull()
    has_old = F.col("o._old").isNotNull()
    cols = []
    for c in spec.columns:
        n, o = F.col(f"n.{c}"), F.col(f"o.{c}")
        if c in pk:
            cols.append(F.when(has_old, o).otherwise(n).alias(c))
        elif c == "created_at":
            cols.append(F.when(has_old, o).otherwise(n).alias(c))
        elif c == "updated_at":
            cols.append(F.when(has_new, ts(now)).otherwise(o).alias(c))
        else:
            cols.append(F.when(has_new, n).otherwise(o).alias(c))
    return j.select(*cols)


def _old_keys(existing: DataFrame, pk: Sequence[str]) -> DataFrame:
    return existing.select(*pk, F.col("created_at").alias("_old_created"), F.lit(True).alias("_hit"))


def _batch_rows(j: DataFrame, spec: S.TableSpec, now) -> DataFrame:
    """Batch rows after the write: a matched key keeps its old ``created_at``
    (Q16: every other column comes from the batch, NULL included);
    ``updated_at = now`` for all."""
    hit = F.col("_hit").isNotNull()
    cols = []
    for c in spec.columns:
        if c == "created_at":
            cols.append(F.when(hit, F.col("_old_created")).otherwise(F.col(c)).alias(c))
        elif c == "updated_at":
            cols.append(ts(now).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def insert_only_new(existing: DataFrame, batch: DataFrame, pk: Sequence[str]) -> DataFrame:
    """JN2/UPS3: batch rows whose key is not in ``existing``."""
    return batch.join(existing.select(*pk), list(pk), "left_anti")


# Keys of a batch that may be sent to all tasks.
FEW_KEYS = 100_000


def insert_only_new_bounded(existing: DataFrame, batch: DataFrame, pk: Sequence[str], few: int = FEW_KEYS) -> DataFrame:
    """JN3: ``insert_only_new`` for a batch of at most ``few`` rows.  Its keys are
    sent to the table, so the table is scanned and not exchanged; a larger batch
    takes the plain way."""
    if batch.limit(few + 1).count() > few:
        return insert_only_new(existing, batch, pk)
    there = existing.select(*pk).join(F.broadcast(batch.select(*pk)), list(pk), "left_semi")
    return batch.join(there, list(pk), "left_anti")


def delete_matching(existing: DataFrame, batch: DataFrame, pk: Sequence[str]) -> DataFrame:
    """JN4: existing rows whose key is not in ``batch``."""
    return existing.join(batch.select(*pk), list(pk), "left_anti")


def update_matched(existing: DataFrame, incoming: DataFrame, table: S.TableSpec | str, now) -> DataFrame:
    """JN1: the existing rows that an upsert updates, after the update."""
    spec = S.table_spec(table)
    pk = list(spec.primary_keys)
    return _batch_rows(prepare_batch(incoming, spec, now).join(_old_keys(existing, pk), pk, "inner"), spec, now)
