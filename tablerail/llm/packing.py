"""Packing documents into fixed windows, planned by non-negative least squares.

A document's ids (its tokens and a closing id) fill whole windows first; what
remains is one piece shorter than a window.  The histogram of these remainders
has at most window - 1 bins, whatever the size of the table.  Shallow
combinations of its lengths that fill a window exactly (pairs, and triples near
an even split) are enumerated, non-negative least squares gives how often each
is repeated so that they use up the histogram, and the counts are rounded down.
Left-over counts fill further exact combinations greedily; what still remains is
packed greedily one piece after the other, a piece that crosses a window's end
being cut there, so only the last window can hold padding.

The plan is made from the histogram alone.  Pieces find their places by their
rank among the pieces of equal length (counted in 256 hash buckets a length, so
a length that a third of all documents share is no hot task).

Defined results: a null or empty text has the closing id only; every row counts
as a document, rows repeating an id too (``start`` counts within the row); an
empty table gives an empty result.  Whole texts of any length are encoded.
Columns other than doc_id and text are ignored."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablerail.llm import common

BUCKETS = 256


# ---------------------------------------------------------------- tokenising

class Encoder:
    """Ids of ``tokenizers`` for the vocabulary file at ``path``.

    Given ``ranks`` (the same vocabulary in tiktoken's form) and its split
    pattern, plain Latin texts go through tiktoken, which gives the same ids and
    is about four times as fast; all others, and texts with very long runs, are
    encoded by ``tokenizers`` itself.  The tests compare both on whole tables."""

    # letters, digits and signs on which every Unicode version agrees
    PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
    LONG_RUN = re.compile(r"\S{1000}|\s{1000}")

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None) -> None:
        self.path, self._exact, self.fast = path, None, None
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.size = 1 + max([*special.values(), *described["model"]["vocab"].values()])
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=table, special_tokens=special)

    @property
    def exact(self):
        """The ``tokenizers`` object, loaded when a text first needs it."""
        if self._exact is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self._exact = Tokenizer.from_file(self.path)
        return self._exact

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and self.PLAIN.fullmatch(text) and not self.LONG_RUN.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@dataclass(frozen=True)
class Vocabulary:
    """Where the tokenizer's files are; the same path on every executor."""
    path: str
    ranks: str | None = None
    pattern: str | None = None
    closing: int = 1


_ENCODERS: dict[Vocabulary, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder a Python worker, kept between batches."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary.path, vocabulary.ranks, vocabulary.pattern)
    return _ENCODERS[vocabulary]


def tokenised(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, row, n, wide, ids): each document's ids with the closing one, as
    little-endian 16-bit numbers, or 32-bit ones where ``wide``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        wide = max(encode.size, vocabulary.closing + 1) > 1 << 16
        kind = "<u4" if wide else "<u2"
        for f in frames:
            counts, ids = [], []
            for text in f["text"]:
                got = np.append(encode(text), np.uint32(vocabulary.closing)) if text else np.array([vocabulary.closing])
                counts.append(len(got))
                ids.append(got.astype(kind).tobytes())
            yield pd.DataFrame({"doc_id": f["doc_id"], "row": f["row"], "n": counts, "wide": wide, "ids": ids})
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return src.mapInPandas(run, "doc_id long, row long, n long, wide boolean, ids binary")


# ------------------------------------------------------------------- planning

def combinations(lengths: list[int], window: int) -> list[tuple[int, ...]]:
    """Pairs and triples of ``lengths`` that fill ``window`` exactly.

    Triples: for each shortest member, the four middle lengths nearest to an even
    split of the rest, so their number stays proportional to the lengths."""
    have = set(lengths)
    found = [(a, window - a) for a in lengths if 2 * a <= window and window - a in have]
    for a in lengths:
        half = (window - a) // 2
        middle = [b for b in range(half, max(a, half - 64) - 1, -1) if b in have and window - a - b in have][:4]
        found += [(a, b, window - a - b) for b in middle]
    return found


def nnls(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 100) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - h|^2, by cyclic coordinate
    descent; A has a sparse column of length counts for each pattern."""
    rest = np.zeros(max(histogram, default=0) + 1)
    for length, n in histogram.items():
        rest[length] = n
    x = np.zeros(len(patterns))
    columns = [np.unique(p, return_counts=True) for p in patterns]
    tolerance = 1e-3
    for _ in range(sweeps):
        most = 0.0
        for j, (at, times) in enumerate(columns):
            new = max(0.0, x[j] + float(times @ rest[at]) / float(times @ times))
            if (step := new - x[j]):
                rest[at] -= step * times
                x[j], most = new, max(most, abs(step))
        if most < tolerance:
            break
    return x


@dataclass
class Plan:
    """Places by (length, rank): segment arrays sorted by length << 40 | first
    rank, and for the rest of each length a place in the residual stream."""
    window: int
    keys: np.ndarray
    ends: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    covered: np.ndarray
    stream: np.ndarray
    residual_at: int
    sequences: int

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(from, length, sequence, offset) of the piece, or of its two parts."""
        at = int(np.searchsorted(self.keys, (length << 40) | rank, side="right")) - 1
        if rank < self.covered[length]:
            i = rank - (int(self.keys[at]) & ((1 << 40) - 1))
            m = int(self.times[at])
            return [(0, length, int(self.sequence[at]) + i // m, int(self.offset[at]) + i % m * length)]
        pos = int(self.stream[length]) + (rank - int(self.covered[length])) * length
        seq, off = divmod(pos, self.window)
        first = min(length, self.window - off)
        parts = [(0, first, self.residual_at + seq, off)]
        if first < length:
            parts.append((first, length - first, self.residual_at + seq + 1, 0))
        return parts


def make_plan(histogram: dict[int, int], window: int) -> Plan:
    """The plan for ``histogram`` (length -> pieces, 0 < length < window)."""
    lengths = sorted(k for k, n in histogram.items() if n)
    patterns = combinations(lengths, window)
    left = {k: histogram[k] for k in lengths}
    counts = np.floor(nnls(patterns, left) + 1e-6).astype(np.int64)
    used = np.zeros(window + 1, dtype=np.int64)
    rows: list[tuple[int, int, int, int, int]] = []  # key, end, times, sequence, offset
    sequence = 0

    def repeat(pattern: tuple[int, ...], wanted: int) -> None:
        nonlocal sequence
        need = dict(zip(*map(np.ndarray.tolist, np.unique(pattern, return_counts=True)), strict=True))
        n = min([wanted, *(left[k] // m for k, m in need.items())])
        if n <= 0:
            return
        offset = 0
        for k, m in need.items():
            rows.append(((k << 40) | int(used[k]), int(used[k]) + n * m, m, sequence, offset))
            used[k] += n * m
            left[k] -= n * m
            offset += k * m
        sequence += n

    for j in np.argsort(-counts, kind="stable"):
        repeat(patterns[j], int(counts[j]))
    for p in patterns:  # what rounding left over and still fills a window
        repeat(p, 1 << 60)
    stream, pos = np.zeros(window + 1, dtype=np.int64), 0
    for k in reversed(lengths):
        stream[k] = pos
        pos += left[k] * k
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(window, cols[0], cols[1], cols[2], cols[3], cols[4], used, stream, sequence, sequence + -(-pos // window))


# --------------------------------------------------------------------- packing

def pack(docs: DataFrame, vocabulary: Vocabulary, window: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset
    and ``ids`` (the piece's ids as little-endian 32-bit numbers)."""
    tokens = common.keep(
        tokenised(docs, vocabulary).withColumn("rem", (F.col("n") % window).cast("int"))
        .withColumn("full", F.expr(f"n div {window}"))
        .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(BUCKETS)).cast("int")), "tokens")
    # at most window x 256 rows, however large the table
    totals = common.keep(tokens.groupBy("rem", "bucket").agg(F.count("*").alias("c"), F.sum("full").alias("f")), "lengths")
    histogram = {r[0]: r[1] for r in totals.groupBy("rem").agg(F.sum("c")).collect()}  # window rows at most
    plan = make_plan({k: n for k, n in histogram.items() if k}, window)
    before = Window.partitionBy("rem").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_rem = Window.orderBy("rem").rowsBetween(Window.unboundedPreceding, -1)
    tops = totals.groupBy("rem").agg(F.sum("f").alias("f")).select("rem", F.coalesce(F.sum("f").over(by_rem), F.lit(0)).alias("ft"))
    offsets = (totals.join(F.broadcast(tops), "rem")
               .select("rem", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
                       (F.col("ft") + F.coalesce(F.sum("f").over(before), F.lit(0))).alias("f0")))
    here = Window.partitionBy("rem", "bucket").orderBy("row")
    ranked = (tokens.join(offsets, ["rem", "bucket"])
              .withColumn("rank", F.col("c0") + F.row_number().over(here) - 1)
              .withColumn("block", F.col("f0") + F.coalesce(
                  F.sum("full").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("doc_id", "n", "rem", "full", "rank", "block", "wide", "ids"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        for f in frames:
            out: list[tuple] = []
            size = 0
            for r in f.itertuples(index=False):
                ids = np.frombuffer(r.ids, dtype="<u4" if r.wide else "<u2").astype("<u4")
                whole = int(r.full)
                parts = [(i * window, window, plan.sequences + int(r.block) + i, 0) for i in range(whole)]
                if r.rem:
                    parts += [(whole * window + a, n, s, o) for a, n, s, o in plan.place(int(r.rem), int(r.rank))]
                for a, n, s, o in parts:
                    out.append((r.doc_id, a, n, int(r.n), s, o, ids[a:a + n].tobytes()))
                    size += 4 * n
                if size > 1 << 24:  # bounded frames, also for very long documents
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)
    return ranked.mapInPandas(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
