"""Packing: exact round trip, the plan, fill."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tablerail.llm import packing as P
from tablerail.llm.queries import vocabulary


def ids_of(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary().path)
    return [t.encode(x, add_special_tokens=False).ids + [1] if x else [1] for x in texts]


def check(pieces, window):
    """Every piece's place: gapless sequences within the window."""
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= window
    return by


def test_documents_round_trip(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    pieces = P.pack(docs, vocabulary()).collect()
    by = check(pieces, 2048)
    want = dict(zip(*(lambda r: ([x.doc_id for x in r], ids_of([x.text for x in r])))(docs.collect()), strict=True))
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(got[p.doc_id]) and p.doc_tokens == len(want[p.doc_id])
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert got == want
    # only the last window of the residual stream is not full
    assert sum(sum(n for _, n in v) < 2048 for v in by.values()) <= 1
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in P.digests(spark.createDataFrame(pieces)).collect()}
    assert all(crc[p.doc_id, p.start] == zlib.crc32(p.ids) for p in pieces)


def test_fast_path_gives_the_same_ids(spark):
    v = vocabulary()
    e = P.Encoder(v.path, v.ranks, v.pattern)
    odd = ["<|endoftext|> x<|endoftext|>", "a  b \n\n c\t", "¡él niño! ß ǅ", "日本語 text", "'s I'LL can't", "x" * 5000, " " * 3000 + "y",
           "   z", "1234567 ½ ²", "\u0000\x1b", "é"]
    for t in odd + [r.text for r in spark.read.parquet(f"{SF01}/pages.parquet").select(F.col("html").alias("text")).collect()]:
        assert e(t).tolist() == e.exact.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    window = 64
    histogram = Counter(rng.choice([1, 2, 3, 7, 21, 30, 32, 34, 40, 57, 62, 63]) for _ in range(rng.choice([1, 5, 400])))
    plan = P.make_plan(histogram, window)
    used = Counter()
    for n, count in histogram.items():
        for r in range(count):
            parts = plan.place(n, r)
            assert sum(p[1] for p in parts) == n and [p[0] for p in parts] == [0, parts[0][1]][:len(parts)]
            for _, length, seq, off in parts:
                assert seq < plan.sequences and off + length <= window
                for k in range(off, off + length):
                    used[seq, k] += 1
    assert all(v == 1 for v in used.values())
    total = sum(n * c for n, c in histogram.items())
    assert plan.sequences == -(-total // window)


def test_least_squares_uses_up_an_even_histogram():
    patterns = P.combinations([24, 40, 16, 48], 64)
    x = P.nnls(patterns, {24: 10, 40: 10, 16: 7, 48: 7})
    fit = {p: v for p, v in zip(patterns, x, strict=True) if v > 0.5}
    assert abs(fit[24, 40] - 10) < 1.5 and abs(fit[16, 48] - 7) < 1.5


def test_edge_rows(spark):
    schema = "doc_id long, text string, row int, n string, ids string"
    rows = [(1, None, 1, "a", "b"), (2, "", 1, None, None), (None, "hello there", 2, "a", "b"), (3, "same", 1, "x", "y"), (3, "same", 1, "x", "y"),
            (4, "long " * 9000, 1, "x", "y")]
    out = P.pack(spark.createDataFrame(rows, schema), vocabulary()).collect()
    check(out, 2048)
    assert sum(p.length for p in out if p.doc_id == 3) == 2 * out[[p.doc_id for p in out].index(3)].doc_tokens
    assert [p.length for p in out if p.doc_id in (1, 2)] == [1, 1]
    assert sum(p.length for p in out if p.doc_id == 4) == len(ids_of(["long " * 9000])[0])
    assert P.pack(spark.createDataFrame([], schema), vocabulary()).count() == 0
