"""Registered queries of the training-data operators, with production parameters
and, where SQL can express the result, DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablerail.llm import (codebooks, kdtree, ledger, mixing, packing, pii, quality, sharding, simhash, toxicity, variants,
                           vptree, warc)
from tablerail.llm.common import read, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(fn: Callable) -> Callable:
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


def vocabulary() -> packing.Vocabulary:
    """The byte-level vocabulary of the installed public tokenizers."""
    import public_tokenizers
    return packing.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN, closing=1)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by supervised subword embeddings."""
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, read(spark, sf_dir, "labels")), threshold=0.7)


@query("op2_shards")
def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feistel shuffle of all documents into 24 shards (law "rows")."""
    return sharding.shard_rows(read(spark, sf_dir, "documents"), 24)


@query("op3_vptree")
def op3_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest by inner product; recall at factor 4 is measured in the tests."""
    v = read(spark, sf_dir, "embeddings")
    return vptree.nearest(v, v.where(F.col("vec_id") % 20 == 0), k=20, factor=4.0)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the learned lexicon."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), threshold=0.5)


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, three-word shingles, two bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, max_bits=2)


@query("op6_mixing", mixing.oracle_sql(share=0.7, power=0.8, seed="mix"))
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sampled to raked source, language and topic targets."""
    rows = mixing.sample(read(spark, sf_dir, "documents"), share=0.7, power=0.8, seed="mix", with_details=True)
    return rows.select("doc_id", F.col("m_source").alias("source"), F.col("m_lang").alias("lang"),
                       F.col("m_topic").alias("topic"), "tokens", F.round("probability", 6).alias("probability"))


@query("op7_warc", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_bytes >= 100 AND p.payload_digest = f.payload_digest""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives, indexed, and read back by URL."""
    return warc.round_trip(spark, read(spark, sf_dir, "pages"), least=100)


@query("op8_kdtree", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
                  row_number() OVER () AS row FROM (SELECT DISTINCT vec_id, embedding FROM embeddings) WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INT) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op8_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact five highest integer inner products."""
    v = read(spark, sf_dir, "embeddings")
    return kdtree.top_k(v, v.where(F.col("vec_id") % 50 == 0), k=5)


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: checked base spans and selected candidates."""
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return packing.digests(packing.pack(read(spark, sf_dir, "documents"), vocabulary(), window=2048))


@query("op11_secrets", ledger.oracle_sql())
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, each distinct text scanned once by a new ledger."""
    versions = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ledger.digests(ledger.scan(versions, shared_path(spark, "secret-ledger")))


@query("op12_codebooks", codebooks.oracle_sql())
def op12_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as eight codes of sixteen entries, six Lloyd rounds."""
    return codebooks.digests(read(spark, sf_dir, "embeddings"))


@query("op13_variants", variants.oracle_sql())
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants.variants(read(spark, sf_dir, "documents"))
