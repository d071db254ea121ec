"""WARC archives with a two-level capture index.

Writing: each task writes one archive to the shared folder, one gzip member per
record.  Records whose payload equals that of a record with a smaller page_id
are revisits and hold no payload.  Each record yields a capture (URL key, page,
file, offset, length).

Index: captures are sorted by reversed-host URL key over range partitions; each
partition becomes one index file of compressed blocks, ended by a sparse
directory (first key and place of each block).  The first level is the small
table of index files with their first and last keys (``MAX_PARTS`` at most).

Reading: keys are sent to the index files that can hold them (binary search in
the first level); a task reads a file's directory, finds the block by binary
search, reads that byte range, finds the captures by binary search, and then
reads each record's byte range alone.

Files are written and read through Arrow's file systems, so the shared folder
can be a mounted one, HDFS or an object store.  A task that runs again writes a
new file under a new name; only files named by the captures count.

Defined results: null html is an empty payload; payloads below ``least`` bytes
are always responses; rows that share both payload and the smallest page_id are
all responses; a null page_id is never referred to and makes a response.  Null
or odd URLs have a key too (the text itself, or the empty one).  Very many
captures of one URL spread over index files.  An empty table gives an empty
result.  Columns other than page_id, url and html are ignored."""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablerail.llm import common

MAX_PARTS = 4096
BLOCK_LINES = 512
DATE = "2024-01-01T00:00:00Z"
CAPTURE = "urlkey string, page_id long, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Reversed-host key: http://a.b.com:80/x#y -> com,b,a)/x, without spaces."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        host, port, parts = "", None, None
    if not host or parts is None:
        key = text
    else:
        key = ",".join(reversed(host.split(".")))
        if port and port != {"http": 80, "https": 443}.get(parts.scheme):
            key += f":{port}"
        key += ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return quote(key, safe="!$&'()*+,/:;=?@[]~%-._")


# ----------------------------------------------------------------------- records

def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def member(kind: str, page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {quote(url or 'urn:none', safe=':/?#[]@!$&()*+,;=%~')}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def parse(data: bytes) -> tuple[int | None, int | None, str, str, int | None]:
    """(page_id, payload bytes, digest, type, refers_to) of one gzip member.

    Length and digest of a response are those of the payload that was read; a
    revisit names its payload's digest and where to find it."""
    raw = zlib.decompress(data, 31)
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in head.decode().split("\r\n")[1:])}

    def page(name: str) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d+)>", name)
        return int(m[1]) if m else None

    block = body[:int(fields["content-length"])]
    me, kind = page(fields["warc-record-id"]), fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "revisit":
        return me, None, stated, kind, page(fields["warc-refers-to"])
    payload = block.partition(b"\r\n\r\n")[2]
    digest = hashlib.sha256(payload).hexdigest()
    if digest != stated:
        raise ValueError(f"record of page {me} is damaged")
    return me, len(payload), digest, kind, None


def file_system(uri: str) -> tuple:
    """(file system, path) of a shared file for Arrow."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri) if "://" in uri or uri.startswith("/") else
                                  re.sub(r"^file:", "file://", uri))


class Ranges:
    """Byte ranges of one shared file at a time."""

    def __init__(self) -> None:
        self.uri, self.file = None, None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self.uri:
            self.close()
            system, path = file_system(uri)
            self.uri, self.file = uri, system.open_input_file(path)
        return self.file.read_at(length, offset)

    def size(self, uri: str) -> int:
        self.read(uri, 0, 0)
        return self.file.size()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.uri, self.file = None, None


# ----------------------------------------------------------------------- writing

def write_archives(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write all pages; returns the captures (kept in the shared folder)."""
    folder = common.shared_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"),
                       F.sha2(payload, 256).alias("digest"))
    # only ids and digests are shuffled to find equal payloads
    repeated = (src.where(F.col("size") >= least).select("digest", "page_id").groupBy("digest")
                .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                .where("n > 1 AND first IS NOT NULL").select("digest", "first"))

    def squeeze(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ids = [None if pd.isna(x) else int(x) for x in f["page_id"]]
            data = [member("response", i, u, d, p) for i, u, d, p in zip(ids, f["url"], f["digest"], f["payload"], strict=True)]
            yield pd.DataFrame({"page_id": pd.array(ids, dtype="Int64"), "url": f["url"], "digest": f["digest"], "member": data})

    # records are compressed where the page was read, so what is shuffled is small
    ready = src.mapInPandas(squeeze, "page_id long, url string, digest string, member binary")
    hung = common.salted_join(ready, repeated, "digest", ["page_id"])

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system = out = None
        uri, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                if out is None:
                    system, path = file_system(uri)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                me = None if pd.isna(r.page_id) else int(r.page_id)
                data = r.member
                if me is not None and not pd.isna(r.first) and int(r.first) < me:
                    data = member("revisit", me, r.url, r.digest, b"", int(r.first))
                out.write(data)
                rows.append((url_key(r.url), me, uri, offset, len(data)))
                offset += len(data)
            yield pd.DataFrame(rows, columns=["urlkey", "page_id", "file", "offset", "length"]).astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    return common.keep(hung.mapInPandas(write, CAPTURE), "captures")


# ------------------------------------------------------------------------- index

def write_index(captures: DataFrame, block_lines: int = BLOCK_LINES, part_rows: int = 200_000) -> DataFrame:
    """Sort the captures into index files; returns the first level: (file,
    first_key, last_key, directory_at), ``MAX_PARTS`` rows at most."""
    spark = captures.sparkSession
    folder = common.shared_path(spark, "warc-index")
    rows = captures.count()
    parts = max(1, min(MAX_PARTS, max(-(-rows // part_rows), min(rows // (4 * block_lines), spark.sparkContext.defaultParallelism))))
    # page and place break ties, so the captures of one URL can fill several files
    in_order = captures.repartitionByRange(parts, "urlkey", "page_id", "file", "offset").sortWithinPartitions(
        "urlkey", "page_id", "file", "offset")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uri = f"{folder}/{uuid.uuid4().hex}.cdx.gz"
        out, offset, first, last = None, 0, None, None
        lines: list[str] = []
        directory: list[str] = []

        def flush() -> None:
            nonlocal offset, lines
            data = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            out.write(data)
            directory.append(f"{lines[0].split(chr(9), 1)[0]}\t{offset}\t{len(data)}")
            offset, lines = offset + len(data), []

        for f in frames:
            for r in f.itertuples(index=False):
                if out is None:
                    system, path = file_system(uri)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out, first = system.open_output_stream(path, compression=None), r.urlkey
                lines.append(f"{r.urlkey}\t{r.file}\t{r.offset}\t{r.length}")
                last = r.urlkey
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.write(gzip.compress("\n".join(directory).encode(), 6, mtime=0))
            out.close()
            yield pd.DataFrame([(uri, first, last, offset)], columns=["file", "first_key", "last_key", "directory_at"])

    return common.keep(in_order.mapInPandas(write, "file string, first_key string, last_key string, directory_at long"), "index-files")


def captures_of(ranges: Ranges, file: str, directory_at: int, keys: Iterator[str]) -> Iterator[tuple[str, str, int, int]]:
    """(key, file, offset, length) of the captures of sorted ``keys`` in one
    index file: binary search in its directory, then in the blocks it names."""
    tail = ranges.read(file, directory_at, ranges.size(file) - directory_at)
    directory = [(k, int(a), int(n)) for k, a, n in (x.split("\t") for x in gzip.decompress(tail).decode().split("\n"))]
    firsts = [d[0] for d in directory]
    held, lines, names = -1, [], []
    for key in keys:
        # the block before the first one that begins with the key may end with it
        b = max(0, bisect.bisect_left(firsts, key) - 1)
        while b < len(directory) and firsts[b] <= key:
            if b != held:
                lines = gzip.decompress(ranges.read(file, *directory[b][1:])).decode().split("\n")
                names, held = [x.split("\t", 1)[0] for x in lines], b
            for at in range(bisect.bisect_left(names, key), bisect.bisect_right(names, key)):
                _, f, o, n = lines[at].split("\t")
                yield key, f, int(o), int(n)
            b += 1


def lookup(urls: DataFrame, index_files: DataFrame) -> DataFrame:
    """The records of ``urls`` (url), read through the index: RECORD columns and
    urlkey, one row per capture.  Repeated URLs count once."""
    level = sorted(tuple(r) for r in index_files.select("first_key", "last_key", "file", "directory_at").collect())
    if len(level) > MAX_PARTS * 64:
        raise ValueError("too many index files for the first level")
    firsts = [x[0] for x in level]

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for key in {url_key(u) for u in f["url"]}:
                at = bisect.bisect_right(firsts, key) - 1
                while at >= 0 and level[at][1] >= key:  # backwards over files the key spans
                    out.append((at, key))
                    at -= 1
            yield pd.DataFrame(out, columns=["part", "urlkey"]).astype({"part": "int32"})

    # one task a file: the file bounds the keys that can match in it
    keys = (urls.select(F.col("url").cast("string").alias("url")).mapInPandas(route, "part int, urlkey string").distinct())
    keys = keys.repartition(max(1, len(level)), "part").sortWithinPartitions("part", "urlkey")

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, archive = Ranges(), Ranges()
        names = ["urlkey", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        whole = {"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"}
        for f in frames:
            for part, rows in f.groupby("part", sort=True):
                _, _, file, at = level[int(part)]
                found = sorted(captures_of(index, file, at, iter(rows["urlkey"].to_list())), key=lambda c: c[1:3])
                out = [(k, *parse(archive.read(a, o, n))) for k, a, o, n in found]
                yield pd.DataFrame(out, columns=names).astype(whole)
        index.close()
        archive.close()

    return keys.mapInPandas(fetch, f"urlkey string, {RECORD}")


def resolved(records: DataFrame) -> DataFrame:
    """Revisits with the payload length of the response they refer to."""
    kept = common.keep(records, "records")
    sizes = (kept.where("record_type = 'response' AND page_id IS NOT NULL")
             .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("__bytes"))
             .withColumn("__key", F.struct("refers_to", "payload_digest")).select("__key", "__bytes"))
    revisits = kept.where("record_type = 'revisit'").withColumn("__key", F.struct("refers_to", "payload_digest"))
    back = common.salted_join(revisits, sizes, "__key", ["page_id"], "inner").withColumn("payload_bytes", F.col("__bytes"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return kept.where("record_type = 'response'").select(*cols).unionAll(back.select(*cols))


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 100) -> DataFrame:
    """Write all pages, index them, and read every record back by its URL."""
    index = write_index(write_archives(pages, least))
    return resolved(lookup(pages, index))
