"""Active-entry Lloyd against plain Lloyd in Python's whole numbers."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tablerail.llm import codebooks as C


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (id, vector) of one length; returns (id, codes, error) rows and the hash."""
    def whole(x):
        a, b = float(x).as_integer_ratio()
        return a * scale // b
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(rows[0][1])
    cut = [(i * d // parts, (i + 1) * d // parts) for i in range(parts)]
    pieces = [[[whole(x) for x in v[a:b]] for a, b in cut] for _, v in rows]
    books = [[list(pieces[i][p]) for i in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(piece, book):
        return min((sum((x - y) ** 2 for x, y in zip(piece, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = [nearest(row[p], books[p])[1] for row in pieces]
            for e in range(len(books[p])):
                own = [row[p] for row, g in zip(pieces, got, strict=True) if g == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = []
    for (i, _), row in zip(rows, pieces, strict=True):
        best = [nearest(row[p], books[p]) for p in range(parts)]
        out.append((i, tuple(b[1] for b in best), sum(b[0] for b in best)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def key(rows):
    return sorted(rows, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def got(df, **options):
    out, books, compared = C.compress(df, label="label", **options)
    return [(r.vec_id, tuple(r.codes), r.error) for r in out.collect()], {r.codebooks for r in out.collect()}, compared


def test_equals_plain_lloyd_on_the_table(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows, names, compared = got(df, block=100)
    want, name = plain([(r.vec_id, r.embedding) for r in df.collect()])
    assert key(rows) == key(want) and names == {name}
    full = len(want) * 8 * 16
    assert compared[0] == full and len(compared) == 7
    assert all(c <= full for c in compared) and min(compared[1:]) < full  # the rule spares comparisons


@pytest.mark.parametrize("seed", range(4))
def test_ties_repeats_and_few_values(spark, seed):
    """Coarse values: many equal distances, repeated vectors and repeated ids."""
    rng = random.Random(seed)
    rows = [(rng.randrange(60), [rng.randrange(-2, 3) / 4096 for _ in range(16)], 1) for _ in range(90)]
    a, names, _ = got(frame(spark, rows).repartition(5), parts=8, entries=6, block=7)
    want, name = plain([r[:2] for r in rows], entries=6)
    assert key(a) == key(want) and names == {name}


def test_any_size_of_number_is_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1e-20, -1e-20, -0.0, 5e-324, 1e300, -1.7e308, 3e15 + 0.5, rng.random()]) for _ in range(8)], 1) for i in range(40)]
    a, names, _ = got(frame(spark, rows), entries=5)
    want, name = plain([r[:2] for r in rows], entries=5)
    want = [(i, c, e if e < 2**63 else None) for i, c, e in want]
    assert key(a) == key(want) and names == {name}
    # with one entry some error leaves the longs: so does the sum
    assert {r.label_error for r in C.digests(frame(spark, [(1, [0.0] * 8, 1), (2, [1e300] * 8, 1), *[(i, [0.0] * 8, 1) for i in range(3, 30)],
                                                           *[(i, [1e300 * i] * 8, 1) for i in range(30, 60)]])).collect()} == {None}


def test_edge_rows(spark):
    v = [float(i) for i in range(10)]
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan")] * 10, 1), (4, [math.inf] * 10, 1), (None, v, None), (5, v, None),
            (6, [x / 2 for x in v], 7), (6, v, 7), (7, [1.0, 2.0, 3.0], 7), (8, [], None)]
    df = frame(spark, rows).select("*", F.lit("x").alias("codes"), F.lit("y").alias("n"))
    out = C.digests(df).collect()
    assert sorted(str(r.vec_id) for r in out) == ["5", "6", "6", "7", "8", "None"]
    assert all(len(r.code) == 16 and r.error == 0 for r in out)
    assert len({r.codebooks_sha256 for r in out}) == 3  # one set of codebooks a length
    assert C.digests(frame(spark, [])).collect() == []


def test_label_errors_add_up(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=24)], [None, 1, 2][i % 3]) for i in range(200)]
    out = C.digests(frame(spark, rows)).collect()
    label = {r[0]: r[2] for r in rows}
    total = {}
    for r in out:
        total[label[r.vec_id]] = total.get(label[r.vec_id], 0) + r.error
    assert len(out) == 200 and all(r.label_error == total[label[r.vec_id]] for r in out)


def test_one_step_equals_a_rescan():
    rng = np.random.default_rng(5)
    for _ in range(200):
        part, book = rng.integers(-3, 4, (50, 2)), rng.integers(-3, 4, (9, 2))
        code, dist = C.rescan(part, book)
        new = book.copy()
        at = rng.random(9) < 0.3
        new[at] += rng.integers(-1, 2, (int(at.sum()), 2))
        moved = (new != book).any(axis=1)
        c, d, n = C.reassign(part, new, moved, code, dist)
        want = C.rescan(part, new)
        assert (c == want[0]).all() and (d == want[1]).all()
        lost = moved[code].sum()
        assert n == (lost * 9 + (50 - lost) * moved.sum() if moved.any() else 0)
