"""What the vector searches share: clean vectors, shards of bounded size cut by space,
the routing of queries to the shards that can matter, and the merge of the best."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablerail.llm import common


def usable(vectors: DataFrame, zero_ok: bool) -> DataFrame:
    """(vec_id, v): rows that take part.

    Null ids, null vectors and vectors with null or non-finite components take
    no part (nor zero vectors, unless ``zero_ok``).  Rows equal in id and vector
    are one; an id that occurs with several vectors is a row for each."""
    v = F.col("embedding").cast("array<double>")
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    src = src.where(F.coalesce(fine, F.lit(False)))
    if not zero_ok:
        src = src.where(F.exists("v", lambda x: x != 0.0))
    return src.distinct()


# Cells are fitted on so many numbers (rows times their length) of hash-chosen
# vectors, and a table has at most so many of them; every row is placed and bounded.
SAMPLE_VALUES = 1 << 22
MOST_CELLS = 512


class Cells:
    """Space cut by median splits, on the widest side of a sample; for each vector
    length a tree of its own, and one cell (0) for the lengths it does not know."""

    def __init__(self, samples: dict[int, np.ndarray], rows: int, shard_rows: int) -> None:
        self.trees: dict[int, tuple] = {}
        self.centres: list[np.ndarray | None] = [None]
        total = sum(len(m) for m in samples.values())
        for d, m in sorted(samples.items()):
            share = len(m) / total
            depth = max(0, math.ceil(math.log2(max(1.0, min(share * rows / shard_rows, share * MOST_CELLS)))))
            self.trees[d] = self._split(m, depth)

    def _split(self, m: np.ndarray, depth: int) -> tuple:
        width = m.max(axis=0) - m.min(axis=0) if m.size else np.zeros(0)
        if depth and len(m) > 1 and width.max(initial=0.0) > 0:
            side = int(np.argmax(width))
            cut = float(np.median(m[:, side]))
            low = m[:, side] < cut
            if not low.any():  # the median is the least value: a very common one
                cut = float(m[m[:, side] > cut, side].min())
                low = m[:, side] < cut
            return (side, cut, self._split(m[low], depth - 1), self._split(m[~low], depth - 1))
        self.centres.append(m.mean(axis=0))
        return (len(self.centres) - 1,)

    def place(self, m: np.ndarray) -> np.ndarray:
        """The cell of each row of a matrix."""
        out = np.zeros(len(m), dtype=np.int64)
        waiting = [(self.trees[m.shape[1]], np.arange(len(m)))] if m.shape[1] in self.trees else []
        while waiting:
            node, at = waiting.pop()
            if len(node) == 1:
                out[at] = node[0]
            else:
                low = m[at, node[0]] < node[1]
                waiting += [(node[2], at[low]), (node[3], at[~low])]
        return out


def _placed(vectors: DataFrame, cells: Cells) -> DataFrame:
    """``vectors`` with their ``cell``."""
    def run(frames):
        for f in frames:
            cell = np.zeros(len(f), dtype=np.int64)
            sizes = f["v"].map(len).to_numpy() if len(f) else np.zeros(0, int)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                if d:
                    cell[at] = cells.place(np.stack(f["v"].iloc[at].to_list()).astype(np.float64))
            yield f.assign(cell=cell)
    return vectors.select("vec_id", "v", "row").mapInPandas(run, "vec_id long, v array<double>, row long, cell long")


def _extents(placed: DataFrame, cells: Cells) -> pd.DataFrame:
    """(cell, d, n, low, high, radius) of all rows: the tight box and the distance from
    the cell's centre.  Each task gives one row a cell, and so does the result."""
    schema = "cell long, d int, n long, low array<double>, high array<double>, radius double"

    def run(frames):
        have: dict[tuple[int, int], list] = {}
        for f in frames:
            for d, (_, m, rows) in matrices(f).items():
                of = rows["cell"].to_numpy()
                for c in np.unique(of).tolist():
                    part = m[of == c]
                    centre = cells.centres[c]
                    r = float(np.linalg.norm(part - centre, axis=1).max()) if centre is not None and len(centre) == d else math.inf
                    low, high = part.min(axis=0), part.max(axis=0)
                    old = have.get((c, d))
                    have[c, d] = [len(part), low, high, r] if old is None else [
                        old[0] + len(part), np.minimum(old[1], low), np.maximum(old[2], high), max(old[3], r)]
        yield pd.DataFrame([(c, d, n, low.tolist(), high.tolist(), r) for (c, d), (n, low, high, r) in have.items()],
                           columns=["cell", "d", "n", "low", "high", "radius"])

    def join(f: pd.DataFrame) -> pd.DataFrame:
        first = f.iloc[0]
        return pd.DataFrame([(first["cell"], first["d"], f["n"].sum(), np.stack(f["low"].to_list()).min(axis=0).tolist(),
                              np.stack(f["high"].to_list()).max(axis=0).tolist(), f["radius"].max())], columns=list(f.columns))
    return placed.mapInPandas(run, schema).groupBy("cell", "d").applyInPandas(join, schema).toPandas()


class Space:
    """Vectors (vec_id, v, row) dealt into shards by cells of space.

    A cell with more than ``shard_rows`` rows is dealt over several shards by hash.
    The driver holds a sample, and a box and a ball for each of at most some
    MOST_CELLS cells (and lengths); no query goes to a shard whose box or ball shows
    that no row there can reach the query's k-th score."""

    def __init__(self, vectors: DataFrame, shard_rows: int) -> None:
        n = vectors.count()
        lengths = vectors.agg(F.max(F.size("v"))).first()[0] or 1
        share = min(1.0, SAMPLE_VALUES / lengths / max(n, 1))
        chosen = vectors.where(F.pmod(F.xxhash64(F.lit(7), "row"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))).toPandas()
        self.cells = Cells({d: m for d, (_, m, _) in matrices(chosen).items() if d}, n, shard_rows)
        self.vectors = common.keep(_placed(vectors, self.cells), "cells")
        self.extents = _extents(self.vectors, self.cells).sort_values(["cell", "d"], ignore_index=True)
        of_cell = self.extents.groupby("cell")["n"].sum()
        parts = np.maximum(1, -(-of_cell.to_numpy() // shard_rows))
        self.first = dict(zip(of_cell.index.tolist(), (np.cumsum(parts) - parts).tolist(), strict=True))
        self.parts = dict(zip(of_cell.index.tolist(), parts.tolist(), strict=True))

    def _shard(self, cell: str, salt: int):
        start = F.create_map(*[F.lit(x) for kv in self.first.items() for x in kv])
        parts = F.create_map(*[F.lit(x) for kv in self.parts.items() for x in kv])
        return (start[F.col(cell)] + F.pmod(F.xxhash64(F.lit(salt), "row"), parts[F.col(cell)])).cast("int")

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cells, (queries, cells)): the largest product a row of each cell can have
        with each query, with a margin for rounding."""
        e = self.extents[self.extents["d"] == q.shape[1]]
        if not len(e):
            return np.zeros(0, dtype=np.int64), np.zeros((len(q), 0))
        low, high = np.stack(e["low"].to_list()), np.stack(e["high"].to_list())
        with np.errstate(over="ignore", invalid="ignore"):
            most = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
            slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) + 1e-300
            norm = np.linalg.norm(q, axis=1)
            for i, (c, r) in enumerate(zip(e["cell"], e["radius"], strict=True)):
                if math.isfinite(r):
                    centre = self.cells.centres[c]
                    ball = q @ centre + norm * r * (1 + 1e-9) + 1e-9 * (np.abs(q) @ np.abs(centre))
                    most[:, i] = np.minimum(most[:, i], np.where(np.isnan(ball), np.inf, ball))
            most = np.where(np.isnan(most) | np.isnan(slack), np.inf, most + slack)
        return e["cell"].to_numpy(dtype=np.int64), most

    def _routed(self, queries: DataFrame, schema: str, home: bool) -> DataFrame:
        """Queries with a ``cell``: the one with the highest bound (``home``), or each
        that may hold a row of at least the query's ``kth`` score (null: any)."""
        space = self._light()

        def run(frames):
            for f in frames:
                out = []
                for _, (_, q, rows) in matrices(f).items():
                    cells, most = space.bounds(q)
                    if not len(cells):
                        continue
                    if home:
                        out.append(rows.assign(cell=cells[np.argmax(most, axis=1)]))
                        continue
                    kth = rows["kth"].to_numpy(dtype=np.float64)
                    # a score outside 64 bits is set to the limit: so is its bound
                    may = np.maximum(most, -(2.0**63)) >= np.where(np.isnan(kth), -np.inf, kth)[:, None]
                    at, c = np.nonzero(may)
                    out.append(rows.iloc[at].assign(cell=cells[c]))
                if out:
                    yield pd.concat(out, ignore_index=True)
        return queries.mapInPandas(run, f"{schema}, cell long")

    def _light(self) -> Space:
        """What tasks need of it."""
        out = object.__new__(Space)
        out.cells, out.extents = self.cells, self.extents
        return out

    def search(self, queries: DataFrame, k: int, query_rows: int, search: Callable, schema: str, name: str) -> DataFrame:
        """Each query's ``k`` best by ``search(shard_frame, query_frame)``, in two waves:
        one shard of the cell that promises most, and then the shards of all cells
        whose bound reaches the k-th score found there.

        Queries with one home cell go in chunks of about ``query_rows`` (small cells
        share one), so a chunk's queries need about the same shards."""
        if not self.first:
            return queries.sparkSession.createDataFrame([], schema)
        base = "vec_id long, v array<double>, row long"
        homed = common.keep(self._routed(queries, base, True).withColumnRenamed("cell", "home"), f"{name}-queries")
        at, chunk, deal = 0.0, {}, {}
        for r in homed.groupBy("home").count().orderBy("home").collect():  # at most one row a cell
            chunk[r[0]], deal[r[0]] = int(at // query_rows), max(1, math.ceil(r[1] / query_rows))
            at += r[1]
            if deal[r[0]] > 1:
                chunk[r[0]] = math.ceil((at - r[1]) / query_rows)
                at = (chunk[r[0]] + deal[r[0]]) * query_rows
        if not chunk:
            return queries.sparkSession.createDataFrame([], schema)
        of = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[F.col("home")]
        q = homed.withColumn("chunk", (of(chunk) + F.pmod(F.xxhash64(F.lit(3), "row"), of(deal))).cast("int"))
        q = q.withColumn("seen", self._shard("home", 5))
        v = self.vectors.withColumn("shard", self._shard("cell", 1)).drop("cell")

        first = common.keep(_meet(v, q.select("vec_id", "v", "row", "chunk", F.col("seen").alias("shard"),
                                              F.lit(None).cast("double").alias("kth")), search, schema), f"{name}-first")
        kth = best(first, k).where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("kth"))
        state = f"{base}, chunk int, seen int, kth double"
        routed = self._routed(q.select("vec_id", "v", "row", "chunk", "seen").join(kth, "row", "left")
                              .select("vec_id", "v", "row", "chunk", "seen", "kth"), state, False)
        start, parts = (F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[F.col("cell")] for m in (self.first, self.parts))
        routed = (routed.withColumn("shard", F.explode(F.sequence(start, start + parts - 1))).withColumn("shard", F.col("shard").cast("int"))
                  .where(F.col("shard") != F.col("seen")).drop("cell", "seen"))
        return first.unionAll(_meet(v, common.keep(routed, f"{name}-routed"), search, schema))


def _meet(vectors: DataFrame, queries: DataFrame, search: Callable, schema: str) -> DataFrame:
    """Run ``search(shard_frame, query_frame)`` for every (shard, chunk) that a query is
    sent to; a shard's rows are sent once for each such chunk, and to no other."""
    pairs = queries.select(F.col("shard").alias("to_shard"), F.col("chunk").alias("to_chunk")).distinct()
    left = (vectors.join(pairs, F.col("shard") == F.col("to_shard"))
            .select("vec_id", "v", "row", "shard", F.col("to_chunk").alias("chunk")))
    return left.groupBy("shard", "chunk").cogroup(queries.groupBy("shard", "chunk")).applyInPandas(search, schema)


def matrices(frame: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, pd.DataFrame]]:
    """The rows by dimension: (ids, matrix, rows); vectors of different lengths
    have no inner product and never meet."""
    out = {}
    sizes = frame["v"].map(len).to_numpy() if len(frame) else np.zeros(0, int)
    for d in np.unique(sizes):
        part = frame[sizes == d]
        m = np.stack(part["v"].to_list()).astype(np.float64) if d else np.zeros((len(part), 0))
        out[int(d)] = (part["vec_id"].to_numpy(dtype=np.int64), m, part)
    return out


def best(found: DataFrame, k: int) -> DataFrame:
    """Merge: the ``k`` highest scores of each query row, ties to the smaller id."""
    w = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))


def keep_top(score: np.ndarray, ids: np.ndarray, k: int, slack: float = 0.0) -> np.ndarray:
    """Positions of the k best by (score descending, id), and of all within
    ``slack`` of the k-th score."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth - slack)
    else:
        at = np.arange(len(score))
    order = at[np.lexsort((ids[at], -score[at]))]
    return order if slack else order[:k]


def prepare(rows: DataFrame, name: str) -> DataFrame:
    """Stored rows with a number each (``row``), so that rows of one id stay apart."""
    return common.keep(rows.withColumn("row", F.monotonically_increasing_id()), name)


def found_frame(found: list[tuple], rows: pd.DataFrame, score: str) -> pd.DataFrame:
    """Results (query row, id, score) beside the queries' ids."""
    ids = dict(zip(rows["row"].tolist(), rows["vec_id"].tolist(), strict=True))
    out = pd.DataFrame(found, columns=["query_row", "vec_id", "score"])
    out.insert(1, "query_id", [ids[r] for r in out["query_row"]])
    return out.astype({"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": score})
