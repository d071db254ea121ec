"""SimHash near-duplicates with Golay-code fuzzy keys.

A fingerprint's 64 bits fall into segments of 22, 21 and 21 bits, each a word of
the binary Golay code (23, 12) after zero padding.  Two fingerprints that differ
in at most two bits have, by the pigeonhole principle, one segment without error
and a second one with at most one.  So for each ordered pair of segments (i, j)
a key is made of segment i itself and of a Golay index of segment j: the message
of the codeword that j decodes to, or, if j lies at the code's covering radius
(three errors), also those of the five codewords one bit farther away.  Words
that differ in at most two bits always have one of these (six at most) in
common.  Pairs that share a key are joined and verified by counting bits.

A key shared by more than ``bucket`` different fingerprints (a large group of
near copies) is not paired up.  Its members are linked through the 65 points of
their radius-one balls instead: two fingerprints differ in at most two bits if
and only if those balls meet, and a point lies in 65 balls at most, so that work
grows with the members and not with their square, and loses no link.

Defined results: a null or empty text (or white space alone) has fingerprint
zero, linked like any other; equal texts always share a component; rows repeated
or with a null doc_id keep one output row each, and a component of null ids only
has a null component_id.  Whole texts of any length are hashed.  Columns of the
input other than ``doc_id`` and ``text`` are ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail.llm import common
from tablerail.llm.components import min_label_components

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
# generator polynomial of the binary Golay code: x^11+x^9+x^7+x^6+x^5+x+1
GENERATOR = 0b101011100011


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of whole ``text`` over shingles of ``words`` words, as unsigned."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    parts = data.split()  # bytes: exactly space and \x09-\x0D
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts[:len(parts) - words + 1].tolist(),
                                                       ends[words - 1:].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 65536):  # bounded memory for very long texts
        block = np.array(hashes[k:k + 65536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as the long with the same 64 bits."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = np.array([fingerprint(t, words) for t in f["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": f["doc_id"], "fp": fps})
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInPandas(run, "doc_id long, fp long")


# ------------------------------------------------------------------ Golay keys

def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where((rest >> bit) & 1, GENERATOR << (bit - 11), 0)
    return rest


def golay_errors() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns that lead to a key: the coset leader
    and, if that has weight three, the five patterns of weight four.  Rows are
    padded with the leader; the second array counts the patterns."""
    single = _syndrome(1 << np.arange(23))
    leaders: dict[int, tuple[int, ...]] = {0: ()}
    fours: dict[int, list[tuple[int, ...]]] = {}
    for a in range(23):
        leaders[int(single[a])] = (a,)
        for b in range(a):
            leaders[int(single[a] ^ single[b])] = (a, b)
            for c in range(b):
                abc = int(single[a] ^ single[b] ^ single[c])
                leaders[abc] = (a, b, c)
                for d in range(c):
                    fours.setdefault(abc ^ int(single[d]), []).append((a, b, c, d))
    table, count = np.zeros((2048, 6), dtype=np.int64), np.ones(2048, dtype=np.int64)
    for s, lead in leaders.items():
        found = [lead] + (fours[s] if len(lead) == 3 else [])
        count[s] = len(found)
        table[s] = [sum(1 << p for p in e) for e in (found + [lead] * 6)[:6]]
    return table, count


def keys_of(fps: np.ndarray, table: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) arrays: all keys of the given fingerprints (int64 bits)."""
    u = fps.view(np.uint64)
    seg = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, keys = [], []
    for j in range(3):
        syn = _syndrome(seg[j])
        for e in range(6):
            at = np.flatnonzero(count[syn] > e)
            index = (seg[j][at] ^ table[syn[at], e]) >> 11
            for i in range(3):
                if i != j:
                    rows.append(at)
                    keys.append(((np.int64(i * 3 + j) << 34) | (seg[i][at] << 12) | index))
    return np.concatenate(rows), np.concatenate(keys)


def golay_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp): every fuzzy key of every fingerprint of ``distinct`` (fp)."""
    table, count = golay_errors()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = f["fp"].to_numpy(dtype=np.int64)
            if len(fps):
                rows, keys = keys_of(fps, table, count)
                yield pd.DataFrame({"key": keys, "fp": fps[rows]})
    return distinct.select("fp").mapInPandas(run, "key long, fp long")


# ----------------------------------------------------------------------- links

def ball_links(members: DataFrame) -> DataFrame:
    """Links (a, b) among ``members`` (fp) at two bits or fewer, as stars around
    the smallest member of each point of the radius-one balls."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(v if v < 1 << 63 else v - (1 << 64)).cast("long")
                                             for v in (1 << k for k in range(64))])
    points = members.select("fp", F.explode(F.transform(flips, lambda e: F.col("fp").bitwiseXOR(e))).alias("point"))
    # 65 members a point at most, by geometry
    stars = points.groupBy("point").agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)
    return (stars.select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a <> b").distinct())


def links(distinct: DataFrame, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """Links (a, b), a < b, whose transitive closure joins all fingerprints of
    ``distinct`` (fp, unique) that differ in at most ``max_bits`` (2 at most)."""
    if max_bits not in (0, 1, 2):
        raise ValueError("the keys guarantee every link up to two bits")
    keys = common.keep(golay_keys(distinct), "golay-keys")
    crowd = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = common.keep(keys.join(crowd, "key"), "golay-shared")
    few = shared.where(F.col("n") <= bucket).select("key", "fp")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key")
             .where("a < b").where(near).select("a", "b").distinct())
    hot = shared.where(F.col("n") > bucket).select("fp").distinct()
    # a ball's centre is one bit from each member, so stars hold two bits; fewer are verified
    crowded = ball_links(hot) if max_bits == 2 else _ball_pairs(hot, max_bits)
    return pairs.unionAll(crowded)


def _ball_pairs(members: DataFrame, max_bits: int) -> DataFrame:
    """Links at one bit: each point that is itself a member, with its neighbours."""
    flips = F.array(*[F.lit(v if v < 1 << 63 else v - (1 << 64)).cast("long") for v in (1 << k for k in range(64))])
    points = members.select(F.col("fp").alias("a"), F.explode(F.transform(
        flips, lambda e: F.col("fp").bitwiseXOR(e))).alias("b"))
    return points.join(members.withColumnRenamed("fp", "b"), "b", "left_semi").where((F.col("a") < F.col("b"))
                                                                                    & F.lit(max_bits > 0))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = common.keep(fingerprints(docs, words), "fingerprints")
    # copies share a fingerprint: one node each, with the smallest id
    nodes = common.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-nodes")
    found = common.keep(links(nodes.select("fp"), max_bits, bucket), "fp-links")
    roots = min_label_components(found)  # node, root: only linked nodes
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    ids = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = common.salted_join(labelled.select("fp", "root"), ids, "root", ["fp"]).select("fp", "component_id")
    return (common.salted_join(prints, by_fp, "fp", ["doc_id"])
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, one document of each component: that with the
    smallest id.  All columns stay.  Of rows that repeat this id the one with
    the smallest text (null first) stays; rows with a null id stay."""
    comp = near_duplicates(docs, words, max_bits)
    first = comp.where("doc_id = component_id").select(F.col("doc_id").alias("first")).distinct()
    # the caller's columns travel in one struct: their names never meet ours
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(first, F.col("id").cast("long") == F.col("first"), "left_semi")
    again = kept.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("again"))
    same = F.col("id") == F.col("again")
    once = kept.join(again, same, "left_anti").select("row")
    # repeated ids: a partial min keeps one row each, however many there are
    least = F.min(F.struct(F.col("row")["text"].alias("text"), "row")).alias("least")
    repeated = kept.join(again, same, "left_semi").groupBy("id").agg(least).select("least.row")
    out = once.unionAll(repeated).unionAll(rows.where("id IS NULL").select("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
