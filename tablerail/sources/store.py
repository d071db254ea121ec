"""Table storage on immutable files (SNK2–SNK4) and lineage cuts.

The rows of a table lie in buckets by extendible hashing.  A bucket is a prefix of
the hash of the key's first column (the URL) and, where one URL alone is too much
for a bucket, a prefix of the hash of the whole key.  A bucket that would pass its
size splits before it is written, so one task writes one file of bounded size; the
directory of all buckets is part of the version's manifest.

A write puts whole new buckets into a folder of its own; a version is its manifest,
which names each bucket's folder.  An upsert reads and rewrites the buckets its
keys fall into and no others; a lookup of URLs opens only the buckets they can be
in.  The manifest also holds each bucket's rows by stage and status, so progress
is read from it alone.  Beside the control table's buckets lie their rows that a
worklist can list, narrow and in worklist order, with a few points of that order in
the manifest: a limited claim reads the head of these and not the table.  Nothing that is being read is ever overwritten (a single
writer is assumed; with a transactional table format the same DataFrames go into
``MERGE``); a write that dies leaves an unnamed folder behind, which ``vacuum``
removes, and the next write goes ahead."""

from __future__ import annotations

import json
import math
import re
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S
from tablerail.session import checkpoint_dir

_VERSION = re.compile(r"^v=(\d+)$")
BUCKET = "_bucket"
HASH_BITS = 40
# Rows of a bucket: some hundred MB.
BUCKET_ROWS = {"url": 2_000_000, "pipeline_control": 2_000_000, "web_page": 50_000, "web_summary": 50_000}
# Buckets of a directory, about, from which on a store that was asked for smaller
# buckets than the table's makes them larger instead of more (up to the table's).
FULL_DIRECTORY = 256
# Counted for each bucket when it is written.
COUNTED = {"pipeline_control": ("stage", "status")}
# The listable rows of a table, kept beside its buckets: the condition, the columns
# (those of the order last) and the kinds whose rows are found together.
@dataclass(frozen=True)
class Queue:
    condition: str
    kinds: tuple[str, ...]
    columns: tuple[str, ...]
    order: tuple[str, ...]


QUEUES = {"pipeline_control": Queue("task_state = 'READY'", ("stage", "status"), ("task_state", "is_claimed", "lease_until"),
                                    ("created_at", "url", "iteration"))}
# Shares of a bucket's listable rows whose last place in the order is noted.
HEAD_SHARES = (1 / 4096, 1 / 1024, 1 / 256, 1 / 64, 1 / 16, 1 / 4, 1.0)
QUEUE_ROW_GROUP = 1 << 20  # bytes: what a read of a head opens at least
# Splits look at so many bits of the hash at most beyond the bucket's own.
LOOK_AHEAD = 14
# Buckets up to this number are dealt to tasks by their place in a list.
LISTED_BUCKETS = 4096


@dataclass(frozen=True)
class Bucket:
    """The rows whose URL hash ends in the ``ubits`` bits ``uval``, and whose key hash
    ends in the ``kbits`` bits ``kval`` (0 bits: all)."""

    ubits: int = 0
    uval: int = 0
    kbits: int = 0
    kval: int = 0
    folder: str | None = None  # None: no rows
    rows: int = 0
    counts: list = field(default_factory=list, compare=False)  # [[stage, status, rows], …]
    heads: list | None = field(default=None, compare=False)  # [[stage, status, dated rows, [first order column at each share]], …]; None: no queue kept

    @property
    def id(self) -> str:
        return f"u{self.ubits}-{self.uval}.k{self.kbits}-{self.kval}"


def _hash(salt: int, columns: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(salt), *columns).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def url_hash(spec: S.TableSpec) -> Column:
    return _hash(1, spec.primary_keys[:1])


def key_hash(spec: S.TableSpec) -> Column:
    return _hash(2, spec.primary_keys)


def bucket_of(spec: S.TableSpec, buckets: Sequence[Bucket]) -> Column:
    """The id of a row's bucket among the given ones; NULL if it is in none."""
    kinds: dict[tuple[int, int], list[str]] = {}
    for b in buckets:
        kinds.setdefault((b.ubits, b.kbits), []).append(b.id)

    def name(u: int, k: int) -> Column:
        part = lambda h, bits: h.bitwiseAND(F.lit((1 << bits) - 1)).cast("string")
        return F.concat(F.lit(f"u{u}-"), part(url_hash(spec), u), F.lit(f".k{k}-"), part(key_hash(spec), k))
    choices = []
    for (u, k), ids in kinds.items():
        whole = len(ids) == 1 << (u + k)
        choices.append(name(u, k) if whole else F.when(name(u, k).isin(ids), name(u, k)))
    return F.coalesce(*choices) if choices else F.lit(None).cast("string")


def split(b: Bucket, sizes: dict[int, int], limit: int, top: int) -> list[Bucket]:
    """``b`` cut until no part is expected to pass ``limit`` rows.

    ``sizes``: rows by URL hash, of which the lowest ``top`` bits are known.  Where
    one such value alone is too much (a hot URL) the whole key's hash goes on."""
    n = sum(sizes.values())
    if n <= limit:
        return [replace(b, folder=None, rows=0)]
    if b.kbits or b.ubits >= top or len(sizes) == 1:
        bits = max(1, math.ceil(math.log2(n / limit)))
        return [replace(b, kbits=b.kbits + bits, kval=b.kval | i << b.kbits, folder=None, rows=0) for i in range(1 << bits)]
    out = []
    for bit in (0, 1):
        part = {v: c for v, c in sizes.items() if v >> b.ubits & 1 == bit}
        out += split(replace(b, ubits=b.ubits + 1, uval=b.uval | bit << b.ubits), part, limit, top)
    return out


class TableStore:
    """Tables under ``root``.  ``bucket_rows``: rows from which a bucket splits, for
    all tables (default: by table, so that a bucket is some hundred MB).  A table of
    more than FULL_DIRECTORY such buckets splits later, so the files of a write and
    the directory on the driver do not grow with the table until its buckets have
    the table's own size."""

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int | None = None):
        self.spark, self.root, self.bucket_rows = spark, root.rstrip("/"), bucket_rows
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- versions -------------------------------------------------------------
    def _versions(self, table: str) -> list[int]:
        p = self._Path(f"{self.root}/{table}")
        if not self._fs.exists(p):
            return []
        found = (_VERSION.match(st.getPath().getName()) for st in self._fs.listStatus(p))
        return sorted(int(m.group(1)) for m in found if m)

    def _manifest(self, table: str, version: int | None = None) -> dict:
        vs = self._versions(table)
        if not vs:
            raise FileNotFoundError(f"table {table} has no committed version under {self.root}")
        stream = self._fs.open(self._Path(f"{self.root}/{table}/v={vs[-1] if version is None else version}"))
        try:
            return json.loads(self._io.toString(stream, self._utf8))
        finally:
            stream.close()

    def _commit(self, table: str, manifest: dict) -> int:
        """Name the buckets' folders in the next version: written aside, then
        renamed, so a version is there wholly or not at all."""
        vs = self._versions(table)
        n = (vs[-1] + 1) if vs else 0
        aside = self._Path(f"{self.root}/{table}/_new-{uuid.uuid4().hex}")
        out = self._fs.create(aside)
        try:
            self._io.write(json.dumps(manifest), out, self._utf8)
        finally:
            out.close()
        if not self._fs.rename(aside, self._Path(f"{self.root}/{table}/v={n}")):
            raise RuntimeError(f"version {n} of {table} was written by someone else")
        return n

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def buckets(self, table: str, version: int | None = None) -> list[Bucket]:
        """The directory of a version."""
        return [Bucket(*b["at"], b["folder"], b["rows"], b["counts"], b.get("heads")) for b in self._manifest(table, version)["buckets"]]

    def marks(self, table: str) -> dict[str, int]:
        """What writers noted with the live version (see ``upsert``)."""
        return self._manifest(table).get("marks", {})

    def _next(self, table: str, buckets: Sequence[Bucket], marks: dict[str, int]) -> int:
        return self._commit(table, {"marks": marks, "buckets": [
            {"at": [b.ubits, b.uval, b.kbits, b.kval], "folder": b.folder, "rows": b.rows, "counts": b.counts, "heads": b.heads}
            for b in buckets]})

    # -- buckets --------------------------------------------------------------
    def _limit(self, table: str, rows: int) -> int:
        """Rows of a bucket in a table of ``rows`` rows."""
        own = BUCKET_ROWS.get(table, 1_000_000)
        if not self.bucket_rows:
            return own
        return max(self.bucket_rows, min(own, math.ceil(rows / FULL_DIRECTORY)))

    def _sizes(self, table: str, keys: DataFrame, buckets: Sequence[Bucket]) -> dict[str, int]:
        """Rows of ``keys`` by bucket (as many numbers as there are buckets, at most)."""
        return {r[0]: r[1] for r in keys.groupBy(bucket_of(S.table_spec(table), buckets).alias("b")).count().collect() if r[0] is not None}

    def touched(self, table: str, keys: DataFrame) -> list[str]:
        """The ids of the buckets that ``keys`` (with the key columns) fall into."""
        return sorted(self._sizes(table, keys, self.buckets(table)))

    def _grown(self, table: str, buckets: list[Bucket], expected: dict[str, int], keys: DataFrame, rows: int) -> list[Bucket]:
        """``buckets`` with those split that are expected to pass their size in a
        table of ``rows`` rows.

        ``keys``: the key columns of the rows to come; they are counted by more bits
        of the URL's hash, and only for buckets that split."""
        spec, limit = S.table_spec(table), self._limit(table, rows)
        over = [b for b in buckets if expected[b.id] > limit]
        if not over:
            return buckets
        ahead = min(LOOK_AHEAD, 3 + max(math.ceil(math.log2(expected[b.id] / limit)) for b in over))
        top = min(HASH_BITS, max(b.ubits for b in over) + ahead)
        low = url_hash(spec).bitwiseAND(F.lit((1 << top) - 1)).alias("low")
        seen: dict[str, dict[int, int]] = {b.id: {} for b in over}
        for r in keys.groupBy(bucket_of(spec, over).alias("b"), low).count().where("b IS NOT NULL").collect():
            seen[r[0]][r[1]] = r[2]
        return [p for b in buckets for p in (split(b, seen[b.id], limit, top) if b.id in seen else [b])]

    def _dealt(self, rows: DataFrame, buckets: Sequence[Bucket]) -> DataFrame:
        """Rows with a BUCKET column, one task (and so one file) a bucket."""
        if len(buckets) > LISTED_BUCKETS:
            return rows.repartition(len(buckets), BUCKET)
        place = F.create_map(*[F.lit(x) for i, b in enumerate(buckets) for x in (b.id, i)])
        return rows.repartitionById(len(buckets), place[F.col(BUCKET)])

    def _put(self, table: str, df: DataFrame, buckets: Sequence[Bucket], seen: tuple[Observation, Sequence[Column]] | None = None) -> list[Bucket]:
        """Write rows by bucket into a new folder; returns the buckets as written.

        ``seen``: aggregates over the rows, with whatever columns ``df`` has beside
        the table's, taken as the rows are written.  They are taken in the writing
        tasks, behind the exchange: a task that runs again there counts once."""
        spec = S.table_spec(table)
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self.root}/{table}/{folder}"
        own = F.coalesce(bucket_of(spec, buckets), F.raise_error(F.lit(f"a row of {table} left its buckets")).cast("string"))
        rows = (df if seen else df.select(*spec.columns)).withColumn(BUCKET, own)
        rows = self._dealt(rows, buckets).sortWithinPartitions(BUCKET, *spec.primary_keys)
        if seen:
            rows = rows.observe(seen[0], *seen[1]).select(*spec.columns, BUCKET)
        rows.write.mode("error").partitionBy(BUCKET).parquet(path)
        kinds = COUNTED.get(table, ())
        schema = T.StructType([*spec.schema.fields, T.StructField(BUCKET, T.StringType())])
        written = self.spark.read.schema(schema).parquet(path)
        found: dict[str, list] = {}
        for r in written.groupBy(BUCKET, *kinds).count().collect():
            found.setdefault(r[0], []).append([*r[1:-1], r[-1]])
        heads = self._put_queue(table, written, folder, buckets) if table in QUEUES else {}
        return [replace(b, folder=folder if b.id in found else None, rows=sum(c[-1] for c in found.get(b.id, [])), counts=found.get(b.id, []),
                        heads=heads.get(b.id, []) if table in QUEUES else None)
                for b in buckets]

    def _queue_path(self, table: str, folder: str) -> str:
        return f"{self.root}/{table}/{folder.replace('data-', 'queue-', 1)}"

    def _put_queue(self, table: str, written: DataFrame, folder: str, buckets: Sequence[Bucket]) -> dict[str, list]:
        """Write the listable rows of a folder's buckets beside it; returns the heads
        by bucket (a few numbers for each)."""
        q, path = QUEUES[table], self._queue_path(table, folder)
        order = [F.col(c).asc_nulls_last() for c in q.order]
        rows = written.where(q.condition).select(BUCKET, *q.kinds, *q.columns, *q.order)
        (self._dealt(rows, buckets).sortWithinPartitions(BUCKET, *q.kinds, *order)
         .write.mode("error").option("parquet.block.size", QUEUE_ROW_GROUP).partitionBy(BUCKET).parquet(path))
        first = q.order[0]
        points = F.percentile_approx(first, [*HEAD_SHARES], 10_000)
        heads: dict[str, list] = {}
        for r in self.spark.read.schema(rows.schema).parquet(path).groupBy(BUCKET, *q.kinds).agg(F.count(first), points).collect():
            heads.setdefault(r[0], []).append([*r[1:-1], [t.isoformat(sep=" ", timespec="microseconds") for t in r[-1] or []]])
        return heads

    def _get(self, table: str, buckets: Sequence[Bucket]) -> DataFrame:
        spec = S.table_spec(table)
        paths = [f"{self.root}/{table}/{b.folder}/{BUCKET}={b.id}" for b in buckets if b.folder]
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        return self.spark.read.schema(spec.schema).parquet(*paths).select(*spec.columns)

    # -- tables ---------------------------------------------------------------
    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self._get(table, self.buckets(table, version))

    def lookup(self, table: str, urls: DataFrame) -> DataFrame:
        """The rows of the given URLs (column ``url``): only buckets whose part of
        the URL hash holds one of them are opened."""
        spec, buckets = S.table_spec(table), self.buckets(table)
        first = spec.primary_keys[0]
        wanted = urls.select(F.col("url").alias(first)).distinct()
        widest = max(b.ubits for b in buckets)
        # as many values as there are buckets, at most
        values = [r[0] for r in wanted.select(url_hash(spec).bitwiseAND(F.lit((1 << widest) - 1))).distinct().collect()]
        ends = {bits: {v & ((1 << bits) - 1) for v in values} for bits in {b.ubits for b in buckets}}
        return self._get(table, [b for b in buckets if b.uval in ends[b.ubits]]).join(wanted, first, "left_semi")

    def queue(self, table: str, kinds: Sequence[tuple]) -> DataFrame:
        """The listable rows of the given kinds (for control: stage and status), from
        the narrow files kept beside the buckets; a bucket without one is read itself."""
        q, spec = QUEUES[table], S.table_spec(table)
        names = [*q.kinds, *q.columns, *q.order]
        schema = T.StructType([spec.schema[c] for c in names])
        wanted = {tuple(k) for k in kinds}
        kept = [b for b in self.buckets(table) if b.folder and b.heads is not None and any(tuple(h[:-2]) in wanted for h in b.heads)]
        plain = [b for b in self.buckets(table) if b.folder and b.heads is None]
        paths = [f"{self._queue_path(table, b.folder)}/{BUCKET}={b.id}" for b in kept]
        rows = self.spark.read.schema(schema).parquet(*paths).select(*names) if paths else self.spark.createDataFrame([], schema)
        if plain:
            rows = rows.unionByName(self._get(table, plain).select(*names))
        one = [reduce(and_, [F.col(c) == F.lit(v) for c, v in zip(q.kinds, k, strict=True)]) for k in kinds]
        return rows.where(q.condition).where(reduce(or_, one, F.lit(False)))

    def head_bounds(self, table: str, kinds: Sequence[tuple], n: int) -> list[str | None]:
        """Bounds of the queue's first order column to read ``n`` rows of the given
        kinds: the first that should hold them by the manifest's points, then wider
        ones, at last None (all rows, those without a value too)."""
        wanted = {tuple(k) for k in kinds}
        buckets = [b for b in self.buckets(table) if b.folder]
        if any(b.heads is None for b in buckets):
            return [None]
        points = []  # (bound, rows it adds): a few for each bucket and kind
        for h in (h for b in buckets for h in b.heads if tuple(h[:-2]) in wanted):
            before = 0.0
            for share, at in zip(HEAD_SHARES, h[-1], strict=False):
                points.append((at, h[-2] * share - before))
                before = h[-2] * share
        out: list[str | None] = []
        have, want = 0.0, float(n)
        for at, more in sorted(points):
            have += more
            if have >= want and at not in out:
                out.append(at)
                want = have * 8
        return [*out, None]

    def counts(self, table: str) -> list[tuple]:
        """Rows by the table's counted columns, from the manifest alone."""
        total: Counter = Counter()
        for b in self.buckets(table):
            for *kind, n in b.counts:
                total[tuple(kind)] += n
        return [(*k, n) for k, n in sorted(total.items(), key=str)]

    def write(self, table: str, df: DataFrame) -> int:
        """Write the whole table as the next version; returns its number."""
        there = self.exists(table)
        buckets = [replace(b, folder=None, rows=0, counts=[]) for b in self.buckets(table)] if there else [Bucket()]
        sizes = self._sizes(table, df, buckets)
        grown = self._grown(table, buckets, {b.id: sizes.get(b.id, 0) for b in buckets}, df, sum(sizes.values()))
        return self._next(table, self._put(table, df, grown), self.marks(table) if there else {})

    def upsert(self, table: str, batch: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame],
               marks: dict[str, int] | None = None) -> int:
        """Write ``apply(existing rows, batch)`` for the batch's buckets only.

        ``apply`` sees the whole rows of those buckets and must not move a key.
        ``marks`` are noted in the same commit: a writer that finds its own mark
        knows that this batch is in."""
        keys = list(S.table_spec(table).primary_keys)
        return self._rewrite(table, batch, lambda old: apply(old, batch), lambda old: old.select(*keys).unionByName(batch.select(*keys)), marks)

    def replace_rows(self, table: str, new_table: DataFrame, changed: DataFrame) -> int:
        """Write the buckets of the ``changed`` keys from ``new_table``, a next
        version of the whole table that differs at those keys only."""
        return self._rewrite(table, changed, lambda old: new_table, lambda old: new_table, None)

    def revise(self, table: str, ids: Sequence[str], change: Callable[[DataFrame], DataFrame], measures: Sequence[Column] = ()) -> dict:
        """Write ``change(rows)`` for the buckets ``ids`` (see ``touched``), in one pass
        over them; returns ``measures``, named aggregates over what ``change`` gave,
        which may have columns beside the table's.

        ``change`` keeps every key and adds none, so no bucket grows and nothing is
        counted beforehand.  Without a bucket nothing is written."""
        live, wanted = self.buckets(table), set(ids)
        hit = [b for b in live if b.id in wanted and b.folder]
        if not hit:
            return {}
        seen = Observation()
        new = self._put(table, change(self._get(table, hit)), hit, (seen, list(measures)) if measures else None)
        rows = {b.id: b.rows for b in new}
        if any(rows[b.id] != b.rows for b in hit):
            raise RuntimeError(f"the rows of {table} changed in number under a revision")
        self._next(table, [b for b in live if b not in hit] + new, self.marks(table))
        return dict(seen.get) if measures else {}

    def _rewrite(self, table: str, changed: DataFrame, rows: Callable[[DataFrame], DataFrame], keys: Callable[[DataFrame], DataFrame],
                 marks: dict[str, int] | None) -> int:
        spec, buckets = S.table_spec(table), self.buckets(table)
        had = self.marks(table)
        more = self._sizes(table, changed, buckets)
        if not more and had == had | (marks or {}):
            return self._versions(table)[-1]
        hit = [b for b in buckets if b.id in more]
        new: list[Bucket] = []
        if hit:
            old = self._get(table, hit)
            grown = self._grown(table, hit, {b.id: b.rows + more[b.id] for b in hit}, keys(old),
                                sum(b.rows for b in buckets) + sum(more.values()))
            out = rows(old)
            new = self._put(table, out.where(bucket_of(spec, grown).isNotNull()) if len(hit) < len(buckets) else out, grown)
        return self._next(table, [b for b in buckets if b.id not in more] + new, had | (marks or {}))

    def vacuum(self, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` versions (readers of an older one must
        have finished) and every data folder that no remaining version names,
        those of dead writes too; returns the versions removed."""
        if keep < 1:
            raise ValueError("keep at least the live version")
        vs = self._versions(table)
        old, live = vs[:-keep], vs[-keep:]
        named = {b.folder for v in live for b in self.buckets(table, v) if b.folder}
        named |= {n.replace("data-", "queue-", 1) for n in named}
        for v in old:
            self._fs.delete(self._Path(f"{self.root}/{table}/v={v}"), False)
        for st in self._fs.listStatus(self._Path(f"{self.root}/{table}")):
            name = st.getPath().getName()
            if name.startswith(("data-", "queue-", "_new-")) and name not in named:
                self._fs.delete(st.getPath(), True)
        return old

    def bootstrap(self, tables=None) -> dict[str, bool]:
        """SNK4: create every registered table that is missing (empty, with its schema);
        unknown names give False."""
        out = {}
        for t in tables or list(S.REGISTRY):
            if t not in S.REGISTRY:
                out[t] = False
                continue
            if not self.exists(t):
                self.write(t, self.spark.createDataFrame([], S.REGISTRY[t].schema))
            out[t] = True
        return out


_MATERIALIZED: list[str] = []


def materialize(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used after side-effecting steps (fetch, model calls) so that branching on
    the result never re-runs them, and to cut long lineages; survives the loss
    of the executors that computed it (unlike a local checkpoint)."""
    spark = df.sparkSession
    base = checkpoint_dir(spark, fallback_dir)
    path = f"{base.rstrip('/')}/tablerail-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _MATERIALIZED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_materialized(spark: SparkSession) -> None:
    """Remove the folders ``materialize`` wrote in this process; call it once the
    results that read them have been stored."""
    while _MATERIALIZED:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_MATERIALIZED.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def dump_page_text(df: DataFrame, path: str, fmt: str = "json") -> None:
    """SNK3: url → text as JSON lines, or as ``--- url ---`` text blocks."""
    if fmt == "json":
        df.select("url", "clean_text").write.mode("error").json(path)
    elif fmt == "txt":
        block = F.format_string("--- %s ---\n%s\n", F.col("url"), F.coalesce(F.col("clean_text"), F.lit("")))
        df.select(block.alias("value")).write.mode("error").text(path)
    else:
        raise ValueError(f"unsupported dump format: {fmt!r}")
