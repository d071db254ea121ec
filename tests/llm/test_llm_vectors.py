"""Vector searches against brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tablerail.llm import kdtree, vptree


def table(spark):
    return spark.read.parquet(f"{SF01}/embeddings.parquet")


def matrix(df):
    rows = df.orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)


def ranked(score, ids, own, k):
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != own][:k]
    return [(int(ids[i]), score[i]) for i in order]


def test_kdtree_is_exact(spark):
    v = table(spark)
    ids, m = matrix(v)
    m = np.floor(m * 256)
    got = {}
    for r in kdtree.top_k(v, v.where("vec_id % 10 = 0"), k=5, shard_rows=90, query_rows=7).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for i in np.flatnonzero(ids % 10 == 0):
        want = ranked(m @ m[i], ids, ids[i], 5)
        assert [got[ids[i]][n + 1] for n in range(5)] == [(a, int(s)) for a, s in want]


@pytest.mark.parametrize("factor,least", [(1.0, 1.0), (4.0, 0.98)])
def test_vptree_recall(spark, factor, least):
    v = table(spark)
    ids, m = matrix(v)
    got = {}
    for r in vptree.nearest(v, v.where("vec_id % 10 = 0"), k=20, factor=factor, shard_rows=300, query_rows=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for i in np.flatnonzero(ids % 10 == 0):
        want = dict(ranked(m @ m[i], ids, ids[i], 20))
        mine = sorted(got[ids[i]])
        assert [x[0] for x in mine] == list(range(1, 21))
        assert all(abs(s - m[i] @ m[list(ids).index(a)]) < 1e-12 for _, a, s in mine)
        assert [(-s, a) for _, a, s in mine] == sorted((-s, a) for _, a, s in mine)
        hits += len(want.keys() & {a for _, a, _ in mine})
    assert hits / (20 * len(got)) >= least


def test_recall_on_more_rows():
    """The registered factor on 10,000 rows of the same kind: recall by shard."""
    rng = np.random.default_rng(0)
    m = rng.normal(size=(10000, 64)) + 2.0 * rng.normal(size=(10, 64))[rng.integers(0, 10, 10000)]
    m /= np.linalg.norm(m, axis=1)[:, None]
    ids, q = np.arange(len(m)), np.arange(0, len(m), 100)
    got = {}
    for a, b, s in vptree.search_shard(ids, m, ids[q], m[q], 1.0, 20, 4.0):
        got.setdefault(a, set()).add(b)
    hits = sum(len(got[i] & {a for a, _ in ranked(m @ m[i], ids, i, 20)}) for i in q)
    assert hits / (20 * len(q)) >= 0.95


@pytest.mark.parametrize("case", ["one outlier of 2", "one outlier of 100", "uniform", "log-normal", "two norms"])
def test_recall_on_mixed_norms(case):
    """The registered factor where norms differ, over one shard."""
    rng = np.random.default_rng(0)
    m = rng.normal(size=(8192, 64)) + 2.0 * rng.normal(size=(10, 64))[rng.integers(0, 10, 8192)]
    m /= np.linalg.norm(m, axis=1)[:, None]
    if case.startswith("one outlier"):
        m[17] *= float(case.split()[-1])
    elif case == "uniform":
        m *= rng.uniform(0.5, 1.5, len(m))[:, None]
    elif case == "log-normal":
        m *= np.exp(0.5 * rng.normal(size=len(m)))[:, None]
    else:
        m *= np.where(rng.random(len(m)) < 0.5, 1.0, 3.0)[:, None]
    ids, q = np.arange(len(m)), np.arange(0, len(m), 80)
    for factor, least in ((4.0, 0.95), (1.0, 1.0)):
        got = {}
        for a, b, s in vptree.search_shard(ids, m, ids[q], m[q], float(np.linalg.norm(m, axis=1).max()), 20, factor):
            got.setdefault(a, set()).add(b)
        hits = sum(len(got[i] & {a for a, _ in ranked(m @ m[i], ids, i, 20)}) for i in q)
        assert hits / (20 * len(q)) >= least


ROWS = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [math.nan, 1.0]),
        (7, [math.inf, 1.0]), (8, [0.5, 0.5]), (8, [0.25, 0.5]), (9, [1.0]), (10, []), (None, [1.0, 1.0]), (11, [-1.0, 0.5])]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, v, i, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label long, shard int, v string")


def test_edge_rows_exact(spark):
    df = frame(spark)
    got = [tuple(r) for r in kdtree.top_k(df, df.where("vec_id in (0, 3, 4, 9, 10)"), k=3).collect()]
    by = {q: sorted(x[1:] for x in got if x[0] == q) for q in {x[0] for x in got}}
    # 8 counts with both vectors; 9 and 10 have no partner of their length
    assert by[0] == [(1, 1, 65536), (2, 2, 65536), (3, 8, 32768)]
    assert by[3] == [(1, 0, 0), (2, 1, 0), (3, 2, 0)] and set(by) == {0, 3}
    assert kdtree.top_k(df.limit(0), df).count() == 0 and kdtree.top_k(df, df.limit(0)).count() == 0


def test_edge_rows_nearest(spark):
    df = frame(spark)
    got = [tuple(r) for r in vptree.nearest(df, df.where("vec_id in (0, 3, 4, 9, 10)"), k=3).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 8, 0.5)]
    assert vptree.nearest(df.limit(0), df).count() == 0


def test_many_equal_vectors_keep_the_smallest_ids(spark):
    rows = [(i, [0.6, 0.8, 0.0]) for i in range(700)] + [(i, [0.0, 0.1, 1.0]) for i in range(700, 720)]
    df = frame(spark, rows)
    for run in (vptree.nearest, kdtree.top_k):
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in run(df, df.where(F.col("vec_id").isin(5, 650)), k=4, shard_rows=200).collect())
        assert got == [(5, 1, 0), (5, 2, 1), (5, 3, 2), (5, 4, 3), (650, 1, 0), (650, 2, 1), (650, 3, 2), (650, 4, 3)]


def test_components_beyond_double_precision():
    big = np.array([[2.0**40, 3.0], [2.0**40, 1.0], [-(2.0**40), 0.0]])
    got = kdtree.search_shard(np.arange(3), big, np.array([0]), big[:1], np.array([-np.inf]), 2)
    assert got == [(0, 1, 2**63 - 1), (0, 2, -2**63)]


def test_rows_of_one_id_stay_apart(spark):
    """An id with several vectors: each is a candidate and a query of its own; rows
    equal in both are one."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [0.5, 0.0]), (2, [0.0, 0.75]), (3, [0.25, 0.25])]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in kdtree.top_k(df, df.where("vec_id = 1"), k=2, shard_rows=2, query_rows=1).collect())
    assert got == sorted([(1, 1, 2, 256 * 128), (1, 2, 3, 256 * 64), (1, 1, 2, 256 * 192), (1, 2, 3, 256 * 64)])
    got = sorted(tuple(r) for r in vptree.nearest(df, df.where("vec_id IN (1, 3)"), k=3, shard_rows=2, query_rows=1).collect())
    assert got == sorted([(1, 1, 2, 0.5), (1, 2, 3, 0.25), (1, 3, 2, 0.0), (1, 1, 2, 0.75), (1, 2, 3, 0.25), (1, 3, 2, 0.0),
                          (3, 1, 1, 0.25), (3, 2, 1, 0.25), (3, 3, 2, 0.1875)])


def test_floors_go_down(spark):
    """Also for tiny negative components, which a remainder would round away."""
    tiny = [-1e-20, -0.0, 0.0, 1e-20, -5e-324, 5e-324, -1 / 512, 1 / 512, -1.0, 3e15, -2.0**50]
    rows = [(0, [256.0])] + [(i + 1, [x]) for i, x in enumerate(tiny)]
    df = frame(spark, [(i, [1 / 256] if i == 0 else v) for i, v in rows])
    got = {r.vec_id: r.score for r in kdtree.top_k(df, df.where("vec_id = 0"), k=20).collect()}
    assert got == {i + 1: math.floor(x * 256) for i, x in enumerate(tiny)}


def clustered(n, centres, seed=0, d=16):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d)) * 4
    return c[rng.integers(0, centres, n)] + 0.05 * rng.normal(size=(n, d))


def counting(monkeypatch, module, folder):
    """Make each task note how many (row, query) pairs it is given."""
    import os
    import uuid
    plain = module.search_shard

    def noted(ids, m, qids, q, *rest):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(str(len(ids) * len(qids)))
        return plain(ids, m, qids, q, *rest)
    monkeypatch.setattr(module, "search_shard", noted)


def noted_pairs(folder):
    import os
    return sum(int(open(os.path.join(folder, f)).read()) for f in os.listdir(folder))


@pytest.mark.parametrize("module", [kdtree, vptree])
def test_queries_go_only_where_a_bound_can_reach(spark, module, tmp_path, monkeypatch):
    """On clustered vectors few of the pairs are searched, and nothing is lost."""
    import sys

    from pyspark import cloudpickle
    m = clustered(3000, 30)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # tasks import the module anew: send it as it is here
    cloudpickle.register_pickle_by_value(sys.modules[module.__name__])
    try:
        counting(monkeypatch, module, str(tmp_path))
        run = module.top_k if module is kdtree else module.nearest
        more = {} if module is kdtree else {"factor": 1.0}
        got = {}
        for r in run(df, df.where("vec_id % 20 = 0"), k=5, shard_rows=100, query_rows=20, **more).collect():
            got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[module.__name__])
    x = np.floor(m * 256) if module is kdtree else m
    ids = np.arange(len(m))
    for i in range(0, 3000, 20):
        want = ranked(x @ x[i], ids, i, 5)
        assert [got[i][n + 1][0] for n in range(5)] == [a for a, _ in want]
    pairs = noted_pairs(str(tmp_path))
    assert 0 < pairs < 0.35 * 3000 * 150


def test_bounds_hold_for_every_row(spark):
    """Boxes and balls against all products, for lengths in and outside the sample."""
    from tablerail.llm import vectors as V
    rng = np.random.default_rng(5)
    mats = {4: clustered(500, 5, 1, 4), 3: rng.normal(size=(200, 3)) * np.exp(rng.normal(size=(200, 1)) * 3), 1: np.full((150, 1), -2.0)}
    rows = [(i, [float(x) for x in v]) for m in mats.values() for i, v in enumerate(m)]
    df = V.prepare(V.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), True), "bounds")
    space = V.Space(df, 40)
    assert space.extents["n"].sum() == df.count() and len(space.first) > 10
    placed = space.vectors.toPandas()
    for d, (_, m, part) in V.matrices(placed).items():
        cells, most = space.bounds(m)
        at = {c: i for i, c in enumerate(cells.tolist())}
        own = np.array([at[c] for c in part["cell"]])
        assert (m @ m.T <= most[:, own]).all() and len(m) == len(mats[d])
        assert (space.cells.place(m) == part["cell"].to_numpy()).all()
    # the cell of the very common vector is dealt over several shards
    assert max(space.parts.values()) == 4
