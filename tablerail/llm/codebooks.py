"""Vector code compression: product codes with codebooks fitted by active-entry Lloyd.

Each component x becomes the integer floor(scale * x); vectors are cut into equal
consecutive parts, and each part position has a codebook of a few entries.  A
round assigns every part to its nearest entry and moves each entry to the floor
of its parts' mean.  All arithmetic is on whole numbers, so results do not depend
on how the rows are dealt.

The active-entry rule: with each part its entry's index and the exact squared
distance are stored.  If that entry did not move, the stored distance still
holds, and no other unmoved entry can have come closer, so the part compares only
the entries that moved; a part whose own entry moved compares all of them.  Equal
distances go to the lower index in both cases.

Scale: vectors travel in blocks of a thousand or so as packed integers, with the
codes and distances beside them; a round reads one stored table, writes the next
and drops the old one.  Each task adds one row of partial sums per dimension,
summed up by Spark; the driver holds the codebooks and their sums only (entries
times dimension numbers).

Defined results: null vectors, and those with null or non-finite components, are
dropped; a null id counts as the largest id; rows that repeat an id are rows of
their own (ordered by their vector); vectors of each length have codebooks of
their own; a length that does not divide is cut as evenly as possible, the longer
parts last; fewer rows than entries give fewer entries; numbers of any size are
exact, and an error too large for a long is null; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablerail.llm import common

STATE = ("dim int, n int, ids array<long>, labels array<string>, vectors binary, codes binary, distances binary, "
         "compared long, limb int, sums array<long>")
LIMB = 40  # partial sums travel in pieces of so many bits
LONG = 1 << 63
Books = dict[int, list[np.ndarray]]  # by dimension: one (entries, width) array a part


# ------------------------------------------------------------- whole numbers

def scaled(m: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) for a matrix of finite doubles, exact at any size."""
    if m.size == 0 or np.abs(m).max() < 2**52 / scale:
        return np.floor(m * scale).astype(np.int64)
    whole = lambda x: math.floor(x * scale) if abs(x) < 2**52 / scale else _times(x, scale)
    return np.array([[whole(float(x)) for x in row] for row in m], dtype=object)


def _times(x: float, scale: int) -> int:
    a, b = x.as_integer_ratio()
    return a * scale // b


def pack(a: np.ndarray) -> bytes:
    """An integer array in the narrowest type that holds it, with its shape."""
    head = json.dumps(list(a.shape)).encode()
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    for t in ("i1", "i2", "i4", "i8"):
        if np.iinfo(t).min <= low and high <= np.iinfo(t).max:
            return b"%s %s\n" % (t.encode(), head) + a.astype("<" + t).tobytes()
    return b"o %s\n" % head + json.dumps([int(x) for x in a.ravel()]).encode()


def unpack(raw: bytes) -> np.ndarray:
    head, body = bytes(raw).split(b"\n", 1)
    kind, shape = head.split(b" ", 1)
    if kind == b"o":
        return narrow(np.array(json.loads(body), dtype=object)).reshape(json.loads(shape))
    return np.frombuffer(body, dtype="<" + kind.decode()).astype(np.int64).reshape(json.loads(shape))


def narrow(a: np.ndarray) -> np.ndarray:
    """Python integers as int64 where they fit."""
    if a.dtype == object and all(-LONG <= x < LONG for x in a.ravel()):
        return a.astype(np.int64)
    return a


def _wide(*arrays: np.ndarray) -> bool:
    """Whether squared distances may leave int64."""
    top = max((max(abs(int(a.min())), abs(int(a.max()))) for a in arrays if a.size), default=0)
    return 4 * top * top * max(1, arrays[0].shape[-1]) >= LONG


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


# -------------------------------------------------------------- one block

def distances(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    if _wide(part, entries):
        part, entries = part.astype(object), entries.astype(object)
    gap = part[:, None, :] - entries[None, :, :]
    return (gap * gap).sum(axis=2) if gap.shape[2] else np.zeros(gap.shape[:2], dtype=np.int64)


def rescan(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and distance of each part's nearest entry, lower index first."""
    d = distances(part, book)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(part)), code]


def reassign(part: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The active-entry step; also returns how many distances it computed."""
    code, dist = code.copy(), dist.copy()
    active = np.flatnonzero(moved)
    if not len(active):
        return code, dist, 0
    lost = moved[code]
    rest, full = np.flatnonzero(~lost), np.flatnonzero(lost)
    if len(full):
        new_code, new_dist = rescan(part[full], book)
        if new_dist.dtype == object:
            dist = dist.astype(object)
        code[full], dist[full] = new_code, new_dist
    if len(rest):
        at, near = rescan(part[rest], book[active])
        at = active[at]
        better = (near < dist[rest]) | ((near == dist[rest]) & (at < code[rest]))
        win = rest[np.asarray(better, dtype=bool)]
        pick = np.asarray(better, dtype=bool)
        if near.dtype == object:
            dist = dist.astype(object)
        code[win], dist[win] = at[pick], near[pick]
    return code, dist, len(full) * len(book) + len(rest) * len(active)


def add_up(total: dict[int, np.ndarray], vectors: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> None:
    """Add a block's sums and counts, laid out by part, entry, (components, count)."""
    dim = vectors.shape[1]
    flat = []
    for p, (a, b) in enumerate(cuts(dim, len(books))):
        k = len(books[p])
        one = np.ones((len(vectors), 1), dtype=np.int64)
        rows = np.concatenate([vectors[:, a:b], one if vectors.dtype != object else one.astype(object)], axis=1)
        wide = rows.dtype == object or (rows.size and max(abs(int(rows.min())), int(rows.max())) * len(rows) >= LONG)
        out = np.zeros((k, b - a + 1), dtype=object if wide else np.int64)
        np.add.at(out, codes[:, p], rows.astype(out.dtype))
        flat.append(out.ravel().astype(object))
    total[dim] = total.get(dim, 0) + np.concatenate(flat)


def limbs(total: dict[int, np.ndarray]) -> Iterator[dict]:
    """Rows of partial sums: each number in pieces that a long can add up."""
    for dim, values in total.items():
        limb, rest = 0, list(values)
        while limb == 0 or any(rest):
            last = all(-(1 << LIMB) < v < (1 << LIMB) for v in rest)
            now = rest if last else [v & ((1 << LIMB) - 1) for v in rest]
            yield {"dim": dim, "limb": limb, "sums": [int(v) for v in now]}
            rest = [] if last else [v >> LIMB for v in rest]
            limb += 1


# --------------------------------------------------------------------- rounds

def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [c.strip().split()[0] for c in STATE.split(", ")]
    f = pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in names})
    return f


def _first(books: Books, scale: int, parts: int, block: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for f in frames:
            for dim, same in f.groupby(f["v"].map(len)):
                dim = int(dim)
                for lo in range(0, len(same), block):
                    g = same.iloc[lo:lo + block]
                    m = np.stack(g["v"].to_list()).astype(np.float64) if dim else np.zeros((len(g), 0))
                    v, book = scaled(m, scale), books[dim]
                    got = [rescan(v[:, a:b], book[p]) for p, (a, b) in enumerate(cuts(dim, parts))]
                    codes = np.stack([c for c, _ in got], axis=1)
                    dist = _columns([d for _, d in got])
                    add_up(total, v, codes, book)
                    ids = [None if pd.isna(i) else int(i) for i in g["vec_id"]]
                    yield _frame([{"dim": dim, "n": len(g), "ids": ids, "labels": list(g["label"]), "vectors": pack(v),
                                   "codes": pack(codes), "distances": pack(dist), "compared": codes.size * len(book[0])}])
        yield _frame(list(limbs(total)))
    return run


def _columns(parts: list[np.ndarray]) -> np.ndarray:
    if any(d.dtype == object for d in parts):
        parts = [d.astype(object) for d in parts]
    return np.stack(parts, axis=1)


def _next(books: Books, moved: dict[int, list[np.ndarray]], parts: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for f in frames:
            for r in f.to_dict("records"):
                dim = int(r["dim"])
                v, codes, dist = unpack(r["vectors"]), unpack(r["codes"]), unpack(r["distances"])
                got = [reassign(v[:, a:b], books[dim][p], moved[dim][p], codes[:, p], dist[:, p])
                       for p, (a, b) in enumerate(cuts(dim, parts))]
                codes, dist = np.stack([g[0] for g in got], axis=1), _columns([g[1] for g in got])
                add_up(total, v, codes, books[dim])
                yield _frame([{**r, "ids": list(r["ids"]), "labels": list(r["labels"]), "codes": pack(codes),
                               "distances": pack(dist), "compared": sum(g[2] for g in got), "limb": None, "sums": None}])
        yield _frame(list(limbs(total)))
    return run


def finite(vectors: DataFrame, label: str | None) -> DataFrame:
    """(vec_id, v, label): rows that take part; the label as text, '' for null."""
    text = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")) if label else F.lit("")
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
                         text.alias("label"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return src.where(F.coalesce(fine, F.lit(False)))


def starts(rows: DataFrame, parts: int, entries: int, scale: int) -> Books:
    """The parts of the vectors with the smallest ids, by dimension.  The rank
    filter is applied before the shuffle, so each task sends a few rows only."""
    w = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    first = (rows.select("vec_id", "v", F.size("v").alias("dim")).withColumn("at", F.row_number().over(w))
             .where(F.col("at") <= entries).orderBy("dim", "at").collect())
    out: Books = {}
    for dim in sorted({r.dim for r in first}):
        own = [r.v for r in first if r.dim == dim]
        v = scaled(np.array(own, dtype=np.float64).reshape(len(own), dim), scale)
        out[dim] = [v[:, a:b] for a, b in cuts(dim, parts)]
    return out


def moved_to(state: DataFrame, books: Books) -> tuple[Books, dict[int, list[np.ndarray]]]:
    """The next codebooks from the stored partial sums, and which entries moved."""
    rows = (state.where(F.col("sums").isNotNull()).select("dim", "limb", F.posexplode("sums").alias("at", "value"))
            .groupBy("dim", "limb", "at").agg(F.sum("value").alias("value")).collect())
    sums: dict[tuple[int, int], int] = {}
    for r in rows:
        sums[r.dim, r.at] = sums.get((r.dim, r.at), 0) + (r.value << (LIMB * r.limb))
    new, moved = {}, {}
    for dim, book in books.items():
        at, new[dim], moved[dim] = 0, [], []
        for part in book:
            k, width = part.shape
            flat = [sums.get((dim, at + i), 0) for i in range(k * (width + 1))]
            at += len(flat)
            to = part.astype(object)
            for e in range(k):
                *total, count = flat[e * (width + 1):(e + 1) * (width + 1)]
                if count:
                    to[e] = [s // count for s in total]
            moved[dim].append(np.array([any(to[e] != part[e].astype(object)) for e in range(k)], dtype=bool))
            new[dim].append(narrow(to))
    return new, moved


def fingerprint(book: list[np.ndarray]) -> str:
    """SHA-256 of all entries' numbers by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for part in book for x in part.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
             label: str | None = None, block: int = 1024) -> tuple[DataFrame, Books, list[int]]:
    """(vec_id, label, dim, codes, error, codebooks) a row, the codebooks, and the
    number of distances computed in each assignment."""
    if not 1 <= entries <= 256:
        raise ValueError("codes hold one byte a part")
    spark = vectors.sparkSession
    rows = finite(vectors, label)
    books = starts(rows, parts, entries, scale)
    path = common.shared_path(spark, "codes")
    rows.mapInPandas(_first(books, scale, parts, block), STATE).write.parquet(path)
    read = lambda p: spark.read.schema(STATE).parquet(p)
    compared = []
    for r in range(rounds + 1):
        state = read(path)
        compared.append(state.agg(F.sum("compared")).first()[0] or 0)
        if r == rounds:
            break
        books, moved = moved_to(state, books)
        if not any(m.any() for dim in moved.values() for m in dim):
            break  # nothing moves any more: later rounds repeat this one
        new = common.shared_path(spark, "codes")
        state.where(F.col("n").isNotNull()).mapInPandas(_next(books, moved, parts), STATE).write.parquet(new)
        common.drop(spark, path)
        path = new
    names = {dim: fingerprint(book) for dim, book in books.items()}

    def rows_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.to_dict("records"):
                total = unpack(r["distances"]).astype(object).sum(axis=1)
                yield pd.DataFrame({"vec_id": pd.Series(r["ids"], dtype="Int64"), "label": r["labels"], "dim": r["dim"],
                                    "codes": list(unpack(r["codes"]).astype(np.int32)),
                                    "error": pd.Series([int(e) if e < LONG else None for e in total], dtype="Int64"),
                                    "codebooks": names[int(r["dim"])]})
    out = (read(path).where(F.col("n").isNotNull()).select("dim", "ids", "labels", "codes", "distances")
           .mapInPandas(rows_of, "vec_id long, label string, dim int, codes array<int>, error long, codebooks string"))
    return out, books, compared


def digests(vectors: DataFrame, label: str = "label") -> DataFrame:
    """Codes as hex, and the error summed over equal labels."""
    rows, _, _ = compress(vectors, label=label)
    rows = common.keep(rows, "coded")
    per = (rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count("error").alias("k"),
                                     F.count("*").alias("n"))
           .select("label", F.expr("CASE WHEN k = n THEN try_cast(s AS BIGINT) END").alias("label_error")))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return common.join_back(rows, per, "label").select("vec_id", code.alias("code"), "error", "label_error",
                                                       F.col("codebooks").alias("codebooks_sha256"))


def oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """DuckDB SQL: plain Lloyd rounds, every part against every entry."""
    dist = "CAST(list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i]))) AS BIGINT)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT row, p.part, min_by(b.entry, struct_pack(d := {dist}, e := b.entry)) AS entry, min({dist}) AS d, any_value(p.v) AS v
  FROM p JOIN b{r} b ON p.part = b.part GROUP BY row, p.part)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT part, entry, i, sum(v[i]) AS s, count(*) AS c FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY ALL),
n{r} AS (SELECT part, entry, list(CAST(CASE WHEN s >= 0 THEN s // c ELSE -((-s + c - 1) // c) END AS BIGINT) ORDER BY i) AS v FROM m{r} GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(n.v, b.v) AS v FROM b{r} b LEFT JOIN n{r} n ON b.part = n.part AND b.entry = n.entry)""")
    last = rounds
    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
                  row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row
           FROM embeddings WHERE embedding IS NOT NULL
             AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
p AS MATERIALIZED (SELECT row, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v FROM k, range({parts}) t(part)),
b0 AS MATERIALIZED (SELECT part, CAST(row - 1 AS BIGINT) AS entry, v FROM p WHERE row <= {entries}),{','.join(steps)},
c AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.codebooks_sha256
FROM k JOIN c ON k.row = c.row, h"""
