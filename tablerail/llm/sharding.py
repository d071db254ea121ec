"""Sharding by a Feistel permutation over global row numbers.

Rows get a global number that depends on the data alone: they are ordered by a
hash bucket, then (doc_id, size, text_crc32); bucket totals give the offsets, so
no task sees all rows.  A Feistel network on the grid a x b, the smallest near
square that holds the N rows, permutes the numbers; results of N or more walk
the cycle until they fall below N.  The permuted number p gives shard p mod n and
slot p div n: a reproducible shuffle in which any row's place can be computed
(`place`), with shard counts at most one apart and gapless slots (law "rows").

Defined results: a null text counts as no bytes, a null doc_id is a key like any
other.  Rows equal in all three columns are counted, not moved: they take
consecutive numbers, and which copy gets which is immaterial.  Fewer rows than
shards leave the last shards empty; an empty table gives an empty result.  Equal
texts (with different ids) are spread like any rows: the method keeps no groups.
Columns other than doc_id and text are ignored; ``shard_documents`` carries them
along and replaces columns named shard or slot."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablerail.llm import common

SEED, ROUNDS = "tablerail", 6
# multipliers and primes of the round function, all below 2^31
MULTIPLY = (1_103_515_245, 1_812_433_253 % 2**31)
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
KEY = ["doc_id", "size", "text_crc32"]
STEPS = 64


def round_keys(seed: str = SEED) -> list[tuple[int, int]]:
    """Two keys below 2^31 for each round, from the seed."""
    out = []
    for r in range(ROUNDS):
        h = hashlib.sha256(f"{seed}:{r}".encode()).digest()
        out.append((int.from_bytes(h[:4], "big") >> 1, int.from_bytes(h[4:8], "big") >> 1))
    return out


def grid(total: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, total - 1)) + 1)
    return a, max(1, -(-total // a))


def place(number: int, total: int, shards: int, seed: str = SEED) -> tuple[int, int]:
    """(shard, slot) of one global row number, computed directly."""
    (a, b), p = grid(total), number
    while True:
        left, right = divmod(p, b)
        for r, (k1, k2) in enumerate(round_keys(seed)):
            v = right if r % 2 == 0 else left
            f = (v * MULTIPLY[0] + k1) % PRIMES[0] * ((v * MULTIPLY[1] + k2) % PRIMES[1]) % PRIMES[2]
            if r % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        p = left * b + right
        if p < total:
            return p % shards, p // shards


def _feistel(p: Column, a: int, b: int, seed: str) -> Column:
    """One pass of the network; the state stays a small struct, so the expression
    does not double with each round."""
    keys = F.array(*[F.struct(F.lit(r % 2 == 0).alias("to_left"), F.lit(k1).cast("long").alias("k1"),
                              F.lit(k2).cast("long").alias("k2")) for r, (k1, k2) in enumerate(round_keys(seed))])

    def turn(state: Column, key: Column) -> Column:
        v = F.when(key.to_left, state.r).otherwise(state.l)
        f = ((v * F.lit(MULTIPLY[0]).cast("long") + key.k1) % PRIMES[0]
             * ((v * F.lit(MULTIPLY[1]).cast("long") + key.k2) % PRIMES[1])) % PRIMES[2]
        return F.struct(F.when(key.to_left, (state.l + f) % a).otherwise(state.l).alias("l"),
                        F.when(key.to_left, state.r).otherwise((state.r + f) % b).alias("r"))

    # (p - p mod b) / b: exact in long arithmetic through "div" on whole numbers
    start = F.struct(F.call_function("div", p - p % b, F.lit(b)).alias("l"), (p % b).cast("long").alias("r"))
    return F.aggregate(keys, start, turn, lambda s: s.l * b + s.r)


def permuted(number: Column, total: int, seed: str = SEED) -> Column:
    """The place of ``number`` (0 to total - 1) in the shuffled order."""
    a, b = grid(total)
    first = _feistel(number, a, b, seed)
    # the a * b - total numbers off the end form a share below 1 / a, and a cycle
    # meets them in a row at most that often; 64 further steps never run out in
    # practice, and a row that did would fail loudly
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first,
                         lambda p, _: F.when(p < total, p).otherwise(_feistel(p, a, b, seed)))
    return F.when(first < total, first).when(walked < total, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def numbered_groups(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, n, first): rows equal in the key, their count
    and first global number; and the number of all rows."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    groups = common.keep(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"),
                    F.crc32(data).alias("text_crc32"))
        .groupBy(*KEY).agg(F.count("*").alias("n"))
        .withColumn("h", F.xxhash64(*KEY)).withColumn("hi", F.col("h").bitwiseAND(255).cast("int"))
        .withColumn("lo", F.shiftright("h", 8).bitwiseAND(255).cast("int")).drop("h"), "shard-groups")
    # 65,536 buckets at most, so both tables of totals are bounded
    totals = groups.groupBy("hi", "lo").agg(F.sum("n").alias("n"))
    tops = totals.groupBy("hi").agg(F.sum("n").alias("n"))
    before = Window.orderBy("hi").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("hi", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("top"))
    inside = Window.partitionBy("hi").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("low", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(tops), "hi")
               .select("hi", "lo", (F.col("top") + F.col("low")).alias("offset")))
    total = groups.agg(F.sum("n")).first()[0] or 0
    here = Window.partitionBy("hi", "lo").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (groups.join(F.broadcast(offsets), ["hi", "lo"])
                .withColumn("first", F.col("offset") + F.coalesce(F.sum("n").over(here), F.lit(0))))
    return numbered.select(*KEY, "n", "first"), total


def shard_rows(docs: DataFrame, shards: int = 24, seed: str = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    groups, total = numbered_groups(docs)
    block = 10_000  # copies are laid out in blocks, so no array grows with them
    rows = (groups.withColumn("b", F.explode(F.expr(f"sequence(0L, (n - 1) div {block})")))
            .withColumn("i", F.explode(F.expr(f"sequence(0L, least({block}L, n - b * {block}L) - 1)")))
            .withColumn("number", F.col("first") + F.col("b") * block + F.col("i")))
    return (rows.withColumn("p", permuted(F.col("number"), total, seed))
            .select(*KEY, F.lit("rows").alias("law"), (F.col("p") % shards).cast("int").alias("shard"),
                    F.expr(f"p div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def shard_documents(docs: DataFrame, shards: int = 24, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` with shard and slot, ready to be written by shard."""
    groups, total = numbered_groups(docs)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"),
                       F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), F.monotonically_increasing_id().alias("__at"))
    rows = rows.withColumn("__key", F.xxhash64(*KEY)).withColumn("__piece", F.pmod(F.xxhash64("__at"), F.lit(64)).cast("int"))
    g = groups.select(F.struct(*KEY).alias("__k"), "n", "first")
    hung = common.salted_join(rows.withColumn("__k", F.struct(*KEY)), g, "__k", ["__at"], "inner")
    # copies: numbered piece by piece, so a large group of copies is split
    pieces = hung.where("n > 1").groupBy("__k", "__piece").agg(F.count("*").alias("c"))
    before = Window.partitionBy("__k").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("__k", "__piece", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("skip"))
    within = F.row_number().over(Window.partitionBy("__k", "__piece").orderBy("__at"))
    copies = (hung.where("n > 1").withColumn("r", within).join(pieces, ["__k", "__piece"])
              .select("__row", (F.col("first") + F.col("skip") + F.col("r") - 1).alias("number")))
    number = hung.where("n = 1").select("__row", F.col("first").alias("number")).unionAll(copies)
    p = permuted(F.col("number"), total, seed)
    return (number.withColumn("p", p).select("__row.*", (F.col("p") % shards).cast("int").alias("shard"),
                                             F.expr(f"p div {shards}").alias("slot")))
