"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# tables written by this process, so that ``clean`` can remove them
_WRITTEN: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a plain local session (tests) may leave it unset; then a temporary
    folder of this machine is set, since driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tablerail-shared-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_name(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder; nothing is created."""
    path = f"{shared_root(spark).rstrip('/')}/{new_name(name)}"
    _WRITTEN.append(path)
    return path


def keep(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder, read it back.

    Later steps (and recomputed tasks after a lost executor) read that copy
    instead of running the plan again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    # the schema is known: no job to read footers for it, and empty tables keep it
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove one path, by Spark's own file system access."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clean(spark: SparkSession) -> None:
    """Remove every table the operators wrote to the shared folder so far.

    Call it when the results have been written: they may read those tables."""
    while _WRITTEN:
        drop(spark, _WRITTEN.pop())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_fold(col: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id has no fold."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % folds


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_by: list[str], how: str = "left",
                salts: int = 16) -> DataFrame:
    """Equi-join of ``big`` with ``small`` (one row per key) on ``key`` that deals
    the rows of one hot key over ``salts`` tasks: each row of ``big`` draws a salt
    from the hash of ``spread_by``, each row of ``small`` is repeated per salt."""
    b = big.withColumn("__salt", F.pmod(F.xxhash64(F.lit(7), *spread_by), F.lit(salts)).cast("int"))
    s = small.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return b.join(s, [key, "__salt"], how).drop("__salt")


def join_back(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with ``per_key`` (one row a key), hot keys apart.

    A key with over a thousandth of all rows is hot: there are under 1,000 of
    them, so their rows of ``per_key`` are broadcast; no other key can fill a
    task.  ``rows`` is read four times: pass a stored, narrow table."""
    total = rows.count()
    hot = F.broadcast(rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > max(1000, total // 1000))
                      .where(F.col(key).isNotNull()).select(key))
    warm = rows.join(hot, key, "left_semi").join(F.broadcast(per_key.join(hot, key, "left_semi")), key, "left")
    return rows.join(hot, key, "left_anti").join(per_key, key, "left").unionAll(warm)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, per_class: int,
                    max_chars: int) -> DataFrame:
    """Training rows: (text, label), at most ``per_class`` documents a class.

    Only ids whose fold is not ``held`` count.  A document labelled both ways,
    and texts over ``max_chars``, are left out of the training sample (scoring
    has no such limit).  The choice follows the hash of the id."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
           .where(id_fold("doc_id", folds) != held)
           .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("__most"))
           .where("label = __most").select("doc_id", "label"))
    order = F.xxhash64(F.lit(11), "doc_id")
    picked = None
    for v in (0, 1):
        part = one.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionAll(part)
    # 2 * per_class ids at most, so the broadcast is bounded by a parameter
    return (docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
            .join(F.broadcast(picked), "doc_id").select("doc_id", "text", F.col("label").cast("int").alias("label")))
