"""Approximate nearest neighbours by inner product with vantage-point trees.

Inner products are not a metric, so a search works in bands of nearly equal
norms.  With M the largest norm of a band and the query scaled to norm M, a row
x whose inner product is at least s lies within sqrt(2 M^2 - 2 s) of the query,
whatever the norms of other bands are; and a band whose M is below s holds no
such row at all.  Vectors are dealt into shards of bounded size by cells of space
(``vectors.Space``: fitted on a bounded sample, every row is placed), and a query is
sent only to shards whose bound reaches its k-th score; a task cuts one shard into bands, builds each band's tree (a vantage point, its median distance,
the nearer half inside, the rest outside) and walks them with a whole chunk of
queries at once, bands of large norms and nearer sides first.

By the triangle inequality a side can be left out if the query is further away
from it than the distance for its k-th product so far.  ``factor`` relaxes this:
a side is left out once that gap exceeds the distance divided by ``factor``; a
larger factor prunes more and may miss rows, factor one restores exact search.
A band's norms reach down to 1 - 1/factor^2 of its M (0.9 at least), so that what
a row lacks in norm alone never makes such a gap.  Bands are told apart by the
exact bound.  Every row is indexed; scores are computed again from the original
vectors in double.

Defined results: vectors that are null, zero or empty, or hold null or
non-finite components take no part, nor do rows with a null id.  Only vectors of
equal length meet.  Rows equal in id and vector are one; an id with several vectors is
a candidate, and a query, for each.  Ties go to the smaller id; fewer candidates than k give fewer rows.  An
empty table gives an empty result.  Other columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail.llm import vectors as V

FOUND = "query_row long, query_id long, vec_id long, score double"
LEAF = 512


class _Walk:
    """One shard's trees and the running best of one chunk of queries (of norm one)."""

    def __init__(self, points: np.ndarray, alone: np.ndarray, has_one: np.ndarray, queries: np.ndarray,
                 qids: np.ndarray, k: int, factor: float) -> None:
        # alone: the id of a point with a single row (where has_one)
        self.x, self.alone, self.has_one, self.q, self.qids = points, alone, has_one, queries, qids
        self.k, self.factor = k, factor
        self.best_s = np.full((len(queries), k), -np.inf)  # sorted products
        self.best_i = np.full((len(queries), k), -1, dtype=np.int64)  # rows of x

    def run(self) -> None:
        norms = np.linalg.norm(self.x, axis=1)
        order = np.argsort(-norms, kind="stable")
        least = max(0.9, 1.0 - 1.0 / self.factor**2)
        a = 0
        while a < len(order):
            top = float(norms[order[a]])
            # a band of one leaf is searched whole, so its norms may differ
            b = max(int(np.searchsorted(-norms[order], -least * top, side="right")), min(a + LEAF, len(order)))
            # no product exceeds the norm; a margin for rounding
            self.visit(self.tree(order[a:b]), np.flatnonzero(self.best_s[:, -1] <= top * (1.0 + 1e-9)), top)
            a = b

    def tree(self, rows: np.ndarray, seed: int = 0) -> tuple:
        """("leaf", rows) or (vantage row, median, inner, outer); the vantage
        point itself stays among the rows."""
        if len(rows) <= LEAF:
            return ("leaf", rows)
        vantage = int(rows[(seed * 7919 + 1) % len(rows)])
        d = np.linalg.norm(self.x[rows] - self.x[vantage], axis=1)
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        # the bounds of each side: inner distances end here, outer ones begin there
        return (vantage, float(d[near].max()), float(d[far].min()),
                self.tree(rows[near], 2 * seed + 1), self.tree(rows[far], 2 * seed + 2))

    def visit(self, node: tuple, active: np.ndarray, top: float) -> None:
        if not len(active):
            return
        if node[0] == "leaf":
            self._leaf(node[1], active)
            return
        vantage, inner_max, outer_min, inner, outer = node
        d = np.linalg.norm(top * self.q[active] - self.x[vantage], axis=1)
        closer = d <= (inner_max + outer_min) / 2
        self.visit(inner, active[closer], top)
        self.visit(outer, active[~closer], top)
        # the other side, where the relaxed triangle inequality cannot rule it out;
        # near-ties of rounding are settled by the exact score, so keep a margin
        lack = np.maximum(top - self.best_s[active, -1], 0.0)
        reach = np.sqrt(2.0 * top * lack + 1e-12 * top * top) / self.factor
        self.visit(outer, active[closer & (outer_min - d <= reach)], top)
        self.visit(inner, active[~closer & (d - inner_max <= reach)], top)

    def _leaf(self, rows: np.ndarray, active: np.ndarray) -> None:
        for a in range(0, len(active), 1024):
            at = active[a:a + 1024]
            s = self.q[at] @ self.x[rows].T
            own = (self.qids[at][:, None] == self.alone[rows][None, :]) & self.has_one[rows][None, :]
            s[own] = -np.inf  # a query's own row
            both_s = np.concatenate((self.best_s[at], s), axis=1)
            both_i = np.concatenate((self.best_i[at], np.broadcast_to(rows, s.shape)), axis=1)
            pick = np.argpartition(-both_s, self.k - 1, axis=1)[:, :self.k]
            ps, pi = np.take_along_axis(both_s, pick, 1), np.take_along_axis(both_i, pick, 1)
            order = np.argsort(-ps, axis=1, kind="stable")
            self.best_s[at], self.best_i[at] = np.take_along_axis(ps, order, 1), np.take_along_axis(pi, order, 1)


def search_shard(ids: np.ndarray, m: np.ndarray, qids: np.ndarray, q: np.ndarray, largest: float, k: int,
                 factor: float, names: np.ndarray | None = None) -> list[tuple]:
    """(query, id, score) of the k nearest that the walk finds in one shard; a query
    goes by its id, or by its entry in ``names``.
    ``largest``, about the largest component of the table, is its unit of length."""
    # equal vectors are one point with its ids in order, so ties cannot crowd a search;
    # k + 1 ids are all that a query (less its own) can need of one point
    m, point = np.unique(m, axis=0, return_inverse=True)
    order = np.lexsort((ids, point.ravel()))
    cuts = np.searchsorted(point.ravel()[order], np.arange(1, len(m)))
    members = [g[:k + 1] for g in np.split(ids[order], cuts)]
    alone = np.array([g[0] if len(g) == 1 else -1 for g in members])
    has_one = np.array([len(g) == 1 for g in members])
    # the order by product does not depend on a query's norm
    queries = q / np.abs(q).max(axis=1, initial=0.0)[:, None]
    queries /= np.linalg.norm(queries, axis=1)[:, None]
    # k spare places: near-ties of rounding are settled by the exact score
    walk = _Walk(m / largest, alone, has_one, queries, qids, 2 * k, factor)
    walk.run()
    out = []
    names = qids if names is None else names
    for n, (qid, name) in enumerate(zip(qids.tolist(), names.tolist(), strict=True)):
        at = walk.best_i[n][np.isfinite(walk.best_s[n])]
        score = (m[at] * q[n]).sum(axis=1)  # the measure itself, in the same order for every row
        found = [(float(s), int(i)) for s, p in zip(score, at, strict=True) for i in members[p] if i != qid]
        out += [(name, i, s) for s, i in sorted(found, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.1, shard_rows: int = 8192,
            query_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row of
    ``queries`` (vec_id, embedding; its own id is no candidate) among ``vectors``."""
    ready = V.prepare(V.usable(vectors, False), "vp-vectors")
    largest = ready.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 1.0  # one number
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            mine = V.matrices(left)
            for d, (qids, qm, rows) in V.matrices(right).items():
                if d in mine:
                    out += search_shard(mine[d][0], mine[d][1], qids, qm, largest, k, factor, rows["row"].to_numpy(dtype=np.int64))
        return V.found_frame(out, right, "float64")

    space = V.Space(ready, shard_rows)
    return V.best(space.search(V.prepare(V.usable(queries, False), "vp-queries"), k, query_rows, search, FOUND, "vp"), k).drop("query_row")
