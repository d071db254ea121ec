"""Exact top-k by integer inner product with KD-trees per shard.

Vectors are quantised and dealt into shards of bounded size by median splits of
space (fitted on a bounded sample; every row is placed), and each task builds one
shard's tree: the widest side of a node's tight bounding box is split at the median.
A query visits the nodes best first, by the largest inner product the
node's box allows, and stops at a box below its k-th best score so far.  The
k-th score propagates in two ways: within a tree from leaf to leaf, and from a
first wave, in which each query searches one shard of the cell that promises most,
to the second wave over the shards whose boxes or balls can still reach it, where
it starts as the bound.  Only safe bounds prune, so results are exact.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows with a null id.  Zero and empty vectors do (score 0).
Only vectors of equal length meet.  Rows equal in id and vector are one; an id with
several vectors is a candidate, and a query, for each.  Components or products too large for a double's 53 bits
are computed with Python integers; a score outside 64 bits is set to the limit.
An empty table gives an empty result.  Other columns are ignored."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail.llm import vectors as V

FOUND = "query_row long, query_id long, vec_id long, score long"
LEAF = 256
LIMIT = float(2**53)


class KDTree:
    """Median splits on the widest side; leaves of at most ``LEAF`` rows."""

    def __init__(self, m: np.ndarray) -> None:
        self.order = np.arange(len(m))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._build(m, 0, len(m))

    def _build(self, m: np.ndarray, a: int, b: int) -> int:
        rows = m[self.order[a:b]]
        low, high = rows.min(axis=0), rows.max(axis=0)
        node = len(self.span)
        self.low.append(low)
        self.high.append(high)
        self.span.append((a, b))
        self.children.append(None)
        if b - a > LEAF and (high > low).any():
            side, mid = int(np.argmax(high - low)), (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(rows[:, side], mid)]
            self.children[node] = (self._build(m, a, a + mid), self._build(m, a + mid, b))
        return node

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, nodes): the largest inner product each box allows."""
        low, high = np.stack(self.low), np.stack(self.high)
        return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def _exact_as_float(m: np.ndarray, q: np.ndarray) -> bool:
    """Whether sums of products stay below 2^53, where doubles are exact."""
    return not m.size or not q.size or m.shape[1] * float(np.abs(m).max()) * float(np.abs(q).max()) < LIMIT


def _search_large(ids: np.ndarray, m: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int, names: np.ndarray) -> list[tuple]:
    """All products with Python integers, for components beyond 53 bits."""
    rows, out = [[int(x) for x in r] for r in m], []
    for qid, name, qr in zip(qids.tolist(), names.tolist(), q, strict=True):
        ints = [int(x) for x in qr]
        scored = ((-sum(x * y for x, y in zip(r, ints, strict=True)), int(i))
                  for r, i in zip(rows, ids, strict=True) if i != qid)
        out += [(name, i, max(-2**63, min(2**63 - 1, -s))) for s, i in heapq.nsmallest(k, scored)]
    return out


def search_shard(ids: np.ndarray, m: np.ndarray, qids: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int,
                 names: np.ndarray | None = None) -> list[tuple]:
    """(query, id, score): the rows of one shard that can be among the k best of each
    query, which goes by its id or by its entry in ``names``.

    ``kth``: the k-th score a query already has elsewhere (-inf if none); rows
    that only tie with it are kept, since a tie goes to the smaller id."""
    names = qids if names is None else names
    if not _exact_as_float(m, q):
        return _search_large(ids, m, qids, q, k, names)
    tree, out = KDTree(m), []
    limits = tree.bounds(q)
    ordered, oids = m[tree.order], ids[tree.order]
    for n, (qid, name, vec) in enumerate(zip(qids.tolist(), names.tolist(), q, strict=True)):
        bound, limit = float(kth[n]), limits[n]
        score, at = np.zeros(0), np.zeros(0, dtype=np.int64)
        frontier = [(-limit[0], 0)]
        while frontier:
            top, node = heapq.heappop(frontier)
            if -top < bound:
                break  # no box left can hold a better row
            if tree.children[node]:
                for c in tree.children[node]:
                    if limit[c] >= bound:
                        heapq.heappush(frontier, (-limit[c], c))
                continue
            a, b = tree.span[node]
            s, i = ordered[a:b] @ vec, oids[a:b]
            good = (s >= bound) & (i != qid)
            score, at = np.concatenate((score, s[good])), np.concatenate((at, i[good]))
            if len(score) >= k:
                keep = V.keep_top(score, at, k)
                score, at = score[keep], at[keep]
                bound = max(bound, float(score[-1]))
        out += [(name, int(i), int(s)) for s, i in zip(score, at, strict=True)]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, shard_rows: int = 8192,
          query_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``queries`` (vec_id,
    embedding; its own id is no candidate) against all ``vectors``."""
    def quantised(df: DataFrame, name: str) -> DataFrame:
        ready = V.usable(df, zero_ok=True)
        # scaling by a power of two is exact; from 2^52 on every double is whole
        floor = lambda x: F.when(F.abs(x) < F.lit(2.0**52), F.floor(x).cast("double")).otherwise(x)
        return V.prepare(ready.withColumn("v", F.transform("v", lambda x: floor(x * F.lit(scale)))), name)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            mine = V.matrices(left)
            for d, (qids, qm, rows) in V.matrices(right).items():
                if d in mine:
                    ids, m, _ = mine[d]
                    kth = rows["kth"].to_numpy(dtype=np.float64) if "kth" in rows else np.full(len(qids), -np.inf)
                    out += search_shard(ids, m, qids, qm, np.where(np.isnan(kth), -np.inf, kth), k, rows["row"].to_numpy(dtype=np.int64))
        return V.found_frame(out, right, "int64")

    space = V.Space(quantised(vectors, "kd-vectors"), shard_rows)
    return V.best(space.search(quantised(queries, "kd-queries"), k, query_rows, search, FOUND, "kd"), k).drop("query_row")
