"""Split reading of JSON lists: one file of any size, many tasks.

A JSON array has no line ends to split at.  The files are read as text whose
records end at ``}``, so Spark cuts them into byte ranges as it does with lines,
and the cuts fall on record ends.  What a range needs to know before it can be
read alone is whether it starts inside a string, how deep, and in which member of
the top-level object:

1. every range is scanned once for both guesses of the first question
   (``summaries``): quotes passed, change of depth, the last key seen at the
   lowest level;
2. running sums over the ranges of a file settle all three (``states``; one narrow
   row a range);
3. every range is scanned again from its true state and cut into pieces of the
   file's lists (``pieces``), each a run of whole elements; elements that cross
   from one range into the next are put together from their ends.

Each piece is parsed alone.  What is left of a file without its lists' contents
(``[]``, ``{"urls": []}``) is parsed too, so that a file that is no JSON is known
as such, whichever range the fault is in.  Bounds: one element and the bytes
between two closing braces must each fit in a row."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from tablerail.sources.store import materialize

END = "}"
# Pieces are cut at the first element end past so many characters.
PIECE_CHARS = 64 * 1024
# Characters outside its lists that one range of a file may hold.
FRAME_CHARS = 8 * 1024 * 1024
# Up to so many ranges (128 MB each by default) their states are sent to all tasks.
BROADCAST_RANGES = 50_000

# Why a file is refused.
NO_JSON = "not valid JSON"
NO_LIST = "neither a list of entries nor {urls: [...]}"
TOO_LARGE = "an entry is too large to parse"
TOO_MUCH = "too much outside the list of entries"
# Bytes from which a VARIANT is refused.
LARGEST = 120 * 1024 * 1024

RANGE = "file string, block long"
SUMMARY = (f"{RANGE}, size long, records long, bytes long, root string, flips int, depth0 int, low0 int, member0 string, "
           "depth1 int, low1 int, member1 string")
PIECE = (f"{RANGE}, seq long, role string, wrap string, listed boolean, first boolean, open_start boolean, open_end boolean, "
         "at long, commas long, text string")

_ESCAPE = re.compile(r"\\.", re.S)
_MARK = re.compile(r'["{}\[\],:]')


def records(reader: DataFrameReader | DataStreamReader, paths) -> DataFrame:
    """(file, block, size, value): the text between closing braces, byte range by byte range."""
    meta = F.col("_metadata")
    return reader.option("lineSep", END).text(paths).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size"),
        F.col("value").cast("binary").alias("value"))


# --------------------------------------------------------------------- scanning

def marks(text: str, inside: bool) -> Iterator[tuple[str, int, int]]:
    """(mark, from, to): brackets, commas and colons outside strings, and whole
    strings as ``"``; a last ``("…", -1, -1)`` says that the text ends in a string.

    Escapes never cross a record: a record ends at a brace, which has none."""
    u = _ESCAPE.sub("__", text) if "\\" in text else text
    at = 0
    if inside:
        at = u.find('"') + 1
        if not at:
            yield '"', -1, -1
            return
    while m := _MARK.search(u, at):
        at = m.end()
        if m.group() == '"':
            end = u.find('"', at)
            if end < 0:
                yield '"', -1, -1
                return
            yield '"', m.start(), end + 1
            at = end + 1
        else:
            yield m.group(), m.start(), at


def name_of(text: str, span: tuple[int, int] | None) -> str | None:
    """The key a string spells; None where it is no string of this record."""
    if span is None:
        return None
    try:
        return json.loads(text[slice(*span)], strict=False)
    except ValueError:
        return None


class Guess:
    """A scan from an assumed start: final state, and the last list or object opened
    at the lowest level, as its bracket and key."""

    def __init__(self, inside: bool, low: int):
        self.inside, self.depth, self.low, self.key, self.member = inside, 0, low, None, None

    def feed(self, text: str) -> None:
        string, ends_inside = None, False
        for mark, i, j in marks(text, self.inside):
            if mark == '"':
                string, ends_inside = (i, j), i < 0
            elif mark in "[{":
                if self.depth == self.low:
                    self.member = mark + (self.key or "")
                self.depth += 1
            elif mark in "]}":
                self.depth -= 1
                if self.depth < self.low:
                    self.low, self.key, self.member = self.depth, None, None
            elif mark == ":" and self.depth == self.low:
                self.key = name_of(text, string)
        self.inside = ends_inside


def _decoded(value) -> str:
    return bytes(value).decode("utf-8", "replace")


def summarize(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each byte range: what a scan from either start comes to."""
    now, row, guesses = None, {}, []

    def done() -> Iterator[pd.DataFrame]:
        if now is not None:
            for n, g in enumerate(guesses):
                row.update({f"depth{n}": g.depth, f"low{n}": g.low, f"member{n}": g.member})
            yield pd.DataFrame([{c.split()[0]: row.get(c.split()[0]) for c in SUMMARY.split(", ")} | {"flips": int(guesses[0].inside)}])

    for f in frames:
        for file, block, size, value in f[["file", "block", "size", "value"]].itertuples(index=False):
            if (file, block) != now:
                yield from done()
                now = (file, block)
                row = {"file": file, "block": block, "size": size, "records": 0, "bytes": 0, "root": None}
                # the first range starts outside any string, and keys of its top level are one deep
                guesses = [Guess(False, 1 if block == 0 else 0)] + ([Guess(True, 0)] if block else [])
            text = _decoded(value)
            row["records"] += 1
            row["bytes"] += len(value) + 1
            if row["root"] is None:
                row["root"] = (text + END).lstrip("﻿ \t\r\n")[:1] or None
            for g in guesses:
                g.feed(text + END)
    yield from done()


def states(summaries: DataFrame) -> DataFrame:
    """(file, block, inside, depth, member, root, unended, end_ok): how each range
    starts; ``unended``: its last record is the file's end, without a brace."""
    of_file = Window.partitionBy("file")
    before = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    s = summaries.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    for c in ("depth", "low", "member"):
        s = s.withColumn(c, F.when(F.col("inside"), F.col(f"{c}1")).otherwise(F.col(f"{c}0")))
    s = s.withColumn("start", F.coalesce(F.sum("depth").over(before), F.lit(0)))
    s = s.withColumn("seen", F.when(F.col("low") + F.col("start") == 1, F.col("member")))
    total, end = F.sum("bytes").over(of_file), F.sum("depth").over(of_file)
    # a compressed file's size says nothing of its text: there the depth decides
    unended = F.when(total == F.col("size"), False).when(total == F.col("size") + 1, True).otherwise(end < 0)
    quotes = F.sum("flips").over(of_file) % 2
    last = F.col("block") == F.max("block").over(of_file)
    # an assumed last brace counts as a step down, unless it would be inside a string
    return s.select("file", "block", "records", "inside", F.col("start").alias("depth"),
                    F.last("seen", ignorenulls=True).over(before).alias("member"),
                    F.first("root", ignorenulls=True).over(upto).alias("root"), (unended & last).alias("unended"),
                    ((quotes == 0) & (end + F.when(unended, 1).otherwise(0) == 0)).alias("end_ok"))


class Cutter:
    """The second scan of one range, from its true state."""

    def __init__(self, file: str, block: int, inside: bool, depth: int, member: str | None, root: str | None):
        self.file, self.block, self.inside, self.depth, self.key = file, block, inside, depth, None
        self.root, self.level = root, 1 if root == "[" else 2
        self.seq = self.commas = self.at = 0
        self.text: list[str] = []
        self.held = self.framed = 0
        self.in_body = depth >= self.level
        self.wrap = "[" if root == "[" else (member or "[")[0]
        self.listed = root == "[" or (root == "{" and member == "[urls")
        self.first, self.open_start = False, True

    def _row(self, role: str, open_end: bool) -> dict:
        text = "".join(self.text)
        row = {"file": self.file, "block": self.block, "seq": self.seq, "role": role, "wrap": self.wrap, "listed": self.listed,
               "first": self.first, "open_start": self.open_start, "open_end": open_end, "at": self.at, "commas": self.commas - self.at,
               "text": text}
        self.seq += 1
        self.text, self.held, self.at = [], 0, self.commas
        self.first = self.open_start = False
        return row

    def _take(self, text: str) -> None:
        self.text.append(text)
        self.held += len(text)

    def feed(self, text: str) -> Iterator[dict]:
        done, string, ends_inside = 0, None, False
        for mark, i, j in marks(text, self.inside):
            if mark == '"':
                string, ends_inside = (i, j), i < 0
            elif mark in "[{":
                if self.depth == self.level - 1 and not self.in_body:
                    self._take(text[done:j])
                    yield from self._frame()
                    done = j
                    self.in_body, self.wrap, self.first, self.open_start = True, mark, True, False
                    self.listed = mark == "[" and (self.root == "[" or self.key == "urls")
                    self.at = self.commas
                self.depth += 1
            elif mark in "]}":
                self.depth -= 1
                if self.in_body and self.depth < self.level:
                    self._take(text[done:i])
                    yield self._row("list", False)
                    done, self.in_body = i, False
            elif mark == "," and self.in_body and self.depth == self.level and self.listed:
                self.commas += 1
            elif mark == ":" and self.depth == 1:
                self.key = name_of(text, string)
        self.inside = ends_inside
        self._take(text[done:])
        if self.in_body:
            if self.held >= PIECE_CHARS and self.depth == self.level and not self.inside and text.endswith(END):
                yield self._row("list", False)
        elif self.held > FRAME_CHARS:
            yield from self._frame()

    def _frame(self) -> Iterator[dict]:
        self.framed += self.held
        if self.framed > FRAME_CHARS:
            self.text = []
            yield self._row("too much", False)
        else:
            yield self._row("frame", False)

    def finish(self) -> Iterator[dict]:
        if self.in_body:
            yield self._row("list", True)
        else:
            yield from self._frame()


def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pieces of every byte range."""
    now, cutter, left, unended = None, None, 0, False
    for f in frames:
        rows: list[dict] = []
        for r in f.itertuples(index=False):
            if (r.file, r.block) != now:
                if cutter:
                    rows += cutter.finish()
                now, left, unended = (r.file, r.block), r.records, r.unended
                cutter = Cutter(r.file, r.block, r.inside, r.depth, r.member, r.root)
            left -= 1
            text = _decoded(r.value)
            if r.block == 0 and left == r.records - 1:
                text = text.removeprefix("﻿")
            rows += cutter.feed(text if unended and left == 0 else text + END)
        if rows:
            yield _pieces(rows)
    if cutter:
        yield _pieces(list(cutter.finish()))


def _pieces(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECE.split(", ")])


# ----------------------------------------------------------------------- plan

def _beside(rows: DataFrame, ranges: DataFrame, few: int) -> DataFrame:
    """``rows`` joined with one narrow row a range; only so many are broadcast."""
    return rows.join(F.broadcast(ranges) if ranges.count() <= few else ranges.hint("merge"), ["file", "block"])


def _glued(pieces: DataFrame) -> DataFrame:
    """Pieces with those that cross ranges put together (only their ends move)."""
    loose = F.col("open_start") | F.col("open_end")
    order = Window.partitionBy("file").orderBy("block", "seq")
    runs = pieces.where((F.col("role") == "list") & loose).withColumn(
        "run", F.sum(F.when(F.col("open_start"), 0).otherwise(1)).over(order))
    whole = (runs.groupBy("file", "run")
             .agg(F.array_sort(F.collect_list(F.struct("block", "seq", "role", "wrap", "listed", "first", "at", "text"))).alias("p"))
             .select("file", "p", F.col("p")[0].alias("h"))
             .select("file", "h.block", "h.seq", "h.role", "h.wrap", "h.listed", "h.first", "h.at",
                     F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text")))
    return pieces.where((F.col("role") != "list") | ~loose).select(*whole.columns).unionByName(whole)


def _parsed(pieces: DataFrame) -> DataFrame:
    """Lists' pieces with ``doc`` (their elements as VARIANT) and ``fault``."""
    blank = F.col("text").rlike(r"^[ \t\r\n]*$")
    rest = F.when(F.col("first") | blank, F.col("text")).otherwise(F.regexp_replace("text", r"^[ \t\r\n]*,", ""))
    p = pieces.where("role = 'list'").withColumn("rest", rest)
    joined = F.col("first") | blank | ((F.length("rest") < F.length("text")) & ~F.col("rest").rlike(r"^[ \t\r\n]*$"))
    closing = F.when(F.col("wrap") == "[", "]").otherwise("}")
    p = p.withColumn("doc", F.try_parse_json(F.concat("wrap", "rest", closing)))
    fault = (F.when(~joined, NO_JSON).when(F.col("doc").isNull() & (F.octet_length("text") >= LARGEST), TOO_LARGE)
             .when(F.col("doc").isNull(), NO_JSON))
    return p.withColumn("fault", fault)


def _of_files(pieces: DataFrame, parsed: DataFrame, at: DataFrame, member: str) -> DataFrame:
    """(file, reason): the files that are no list, nor an object with one."""
    frames = pieces.where("role <> 'list'")
    size = frames.groupBy("file").agg(F.sum(F.length("text")).alias("n"), F.bool_or(F.col("role") == "too much").alias("much"))
    much = F.col("much") | (F.col("n") > FRAME_CHARS)
    # what lies outside the lists is gathered only where it is known to be little
    text = (frames.join(size.where(~much).select("file"), "file", "left_semi").groupBy("file")
            .agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("p"))
            # inside brackets, so that text after the document is a fault and not ignored
            .select("file", F.try_parse_json(F.concat(F.lit("["), F.array_join(F.transform("p", lambda x: x["text"]), ""), F.lit("]"))).alias("doc"))
            .select("file", F.try_variant_get("doc", "$", "array<variant>").alias("docs"))
            .select("file", F.when(F.size("docs") == 1, F.col("docs")[0]).alias("doc")))
    kind = F.regexp_extract(F.schema_of_variant("doc"), "^([A-Z]+)", 1)
    listed = (kind == "ARRAY") | ((kind == "OBJECT") & F.try_variant_get("doc", f"$.{member}", "array<variant>").isNotNull())
    shape = text.select("file", F.when(F.col("doc").isNull(), NO_JSON).when(~F.coalesce(listed, F.lit(False)), NO_LIST).alias("shape"))
    ends = at.groupBy("file").agg(F.bool_and("end_ok").alias("end_ok"))
    faults = parsed.groupBy("file").agg(F.max("fault").alias("fault"))
    all_files = (ends.join(size.select("file", much.alias("much")), "file", "left").join(shape, "file", "left").join(faults, "file", "left"))
    reason = (F.when(F.col("much"), TOO_MUCH).when(~F.col("end_ok"), NO_JSON)
              .otherwise(F.coalesce("fault", "shape")))
    return all_files.select("file", reason.alias("reason"))


def elements(raw: DataFrame, member: str = "urls", few: int = BROADCAST_RANGES) -> DataFrame:
    """(file, pos, item, reason): the elements of every file's list, in VARIANT.

    ``raw``: see ``records``.  A file's list is the file itself or the ``member``
    of the object it holds.  A file that is neither is one row with a reason and
    no position, and none of its elements."""
    at = materialize(states(raw.mapInPandas(summarize, SUMMARY)))
    ordered = raw.withColumn("order", F.monotonically_increasing_id())
    # a join that exchanges rows must not lose their order inside a range
    beside = _beside(ordered, at.drop("end_ok"), few).sortWithinPartitions("file", "block", "order")
    cuts = materialize(beside.mapInPandas(cut, PIECE))
    pieces = _glued(cuts)
    parsed = materialize(_parsed(pieces).select("file", "block", "listed", "first", "at", "doc", "fault"))
    verdict = materialize(_of_files(pieces, parsed, at, member))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    passed = cuts.where("listed").groupBy("file", "block").agg(F.sum("commas").alias("commas"))
    ranges = (at.select("file", "block").join(passed, ["file", "block"], "left").join(verdict.where("reason IS NULL"), "file", "left_semi")
              .select("file", "block", F.coalesce(F.sum("commas").over(before), F.lit(0)).alias("passed")))
    good = _beside(parsed.where("listed AND doc IS NOT NULL"), materialize(ranges), few)
    start = F.col("passed") + F.col("at") + F.when(F.col("first"), 0).otherwise(1)
    items = (good.select("file", start.alias("start"), F.posexplode(F.try_variant_get("doc", "$", "array<variant>")).alias("i", "item"))
             .select("file", (F.col("start") + F.col("i")).alias("pos"), "item", F.lit(None).cast("string").alias("reason")))
    bad = verdict.where("reason IS NOT NULL").select("file", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("variant").alias("item"), "reason")
    return items.unionByName(bad)
