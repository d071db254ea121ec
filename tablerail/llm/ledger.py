"""Secret scans by an incremental ledger of blobs.

Every historical version of every path is addressed by the SHA-256 of its text (a
null text is the empty one), so equal versions are one blob wherever they stand.
The ledger is a folder of Parquet runs; a row says which rules, by name and
version, have been run over a blob and what they found.  ``update`` scans only
the pairs of blob and rule version that no finished run holds: a second scan of
the same versions reads no text at all, a new version of one rule runs that rule
alone, and a run that dies leaves nothing that counts (a run counts from its
``_SUCCESS`` on).  ``findings`` joins the ledger back to all paths.

Scale: the digests of all versions are one narrow table.  Texts pass one shuffle,
where the copies of a blob collapse before and after it; if few blobs are unseen,
only their texts do.  Joins back to the paths hold only blobs with findings, and
the copies of the commonest blobs never meet in one task (``common.join_back``).

Defined results: null and empty texts are one blob without findings; repeated
rows each get their findings; an empty table gives an empty result; the caller's
columns travel in one struct, so any names are fine; texts of any length are
scanned whole, and positions count code points."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablerail.llm import common


@dataclass(frozen=True)
class Rule:
    """One kind of secret: a pattern and the least length of one of its groups.

    Matches are leftmost and do not overlap; those too short are dropped, without
    another try inside them.  ``hint`` names lower-case words of which a text
    must hold one before the pattern is tried (a speed-up, no condition)."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the three base kinds, in the order of results.
BASE = (
    Rule("assign", 1, r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8, hint=("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16, hint=("akia",)),
    # runs of hex digits are maximal, so asking for 32 in the pattern drops the same ones
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
ADDED = (
    Rule("pem", 1, r"-----BEGIN(?: [A-Z0-9]+)* PRIVATE KEY-----", hint=("private key",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint=("eyj",)),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hint=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hint=("xox",)),
    Rule("login", 1, r"://[^\s/:@]{1,64}:([^\s/:@]{4,128})@", hint=("://",)),
    Rule("bearer", 1, r"(?ai:bearer)\x20+([A-Za-z0-9+/_.=-]{20,})", hint=("bearer ",)),
)
RULES = BASE + ADDED

SPAN = "struct<start:int, at:int, end:int, rule:string>"
ROW = f"digest binary, rules array<string>, found array<{SPAN}>"
# Few unseen blobs: up to so many digests (32 bytes each) are sent to all tasks.
FEW_BLOBS = 50_000


def spans(text: str, rules: Sequence[Rule]) -> list[tuple[int, int, int, str]]:
    """(start, position of the rule, end, rule name) of every match, in order."""
    out = []
    low = text.lower()
    for at, rule in enumerate(rules):
        if rule.hint and not any(h in low for h in rule.hint):
            continue
        for m in re.finditer(rule.pattern, text):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), at, m.end(), rule.name))
    return sorted(out)


def digest_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


# ---------------------------------------------------------------------- ledger

def _runs(spark: SparkSession, ledger: str) -> list[str]:
    """The finished runs of the ledger."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(ledger)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{ledger.rstrip('/')}/run-*/_SUCCESS")) or []
    return sorted(s.getPath().getParent().toString() for s in done)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(digest, rules, found): all finished runs."""
    runs = _runs(spark, ledger)
    return spark.read.schema(ROW).parquet(*runs) if runs else spark.createDataFrame([], ROW)


def address(versions: DataFrame, text: str = "text") -> DataFrame:
    """(row, digest): each version's other columns, and the address of its text."""
    others = [F.col(f"`{c}`") for c in versions.columns if c != text]
    row = F.struct(*others) if others else F.struct(F.lit(True).alias("version"))
    return versions.select(row.alias("row"), digest_of(text).alias("digest"))


def unseen(addressed: DataFrame, seen: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(digest, todo): blobs with the names of the rules no run has tried on them."""
    blobs = addressed.select("digest").distinct()
    had = seen.groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("had"))
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = F.array_except(names, F.coalesce("had", F.array().cast("array<string>")))
    return blobs.join(had, "digest", "left").select("digest", todo.alias("todo")).where(F.size("todo") > 0)


def update(versions: DataFrame, addressed: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text",
           few: int = FEW_BLOBS) -> int:
    """Scan what the ledger lacks, as one new run; returns the number of blobs."""
    spark = versions.sparkSession
    todo = common.keep(unseen(addressed, read_ledger(spark, ledger), rules), "ledger-todo")
    blobs = todo.count()
    if not blobs:
        return 0
    src = versions.select(digest_of(text).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if blobs <= few:
        src = src.join(F.broadcast(todo.select("digest")), "digest", "left_semi")
    texts = src.groupBy("digest").agg(F.first("text").alias("text")).join(todo, "digest")
    by_name = {r.name: r for r in rules}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [spans(t, [r for r in by_name.values() if r.name in set(names)])
                     for t, names in zip(f["text"], f["todo"], strict=True)]
            yield pd.DataFrame({"digest": f["digest"], "rules": f["todo"],
                                "found": [[dict(zip(("start", "at", "end", "rule"), s, strict=True)) for s in x] for x in found]})
    texts.mapInPandas(run, ROW).write.parquet(f"{ledger.rstrip('/')}/{common.new_name('run')}")
    return blobs


def findings(addressed: DataFrame, seen: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, digest, found) for every path; ``found`` holds (start, at, end, kind) of
    the given rules by start, then in the order of the rules."""
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.struct(F.lit(i).alias("at"), F.lit(r.kind).alias("kind")))])
    one = (seen.select("digest", F.explode("found").alias("s")).select("digest", "s", place[F.col("s.rule")].alias("p"))
           .where(F.col("p").isNotNull())
           .select("digest", F.struct(F.col("s.start").alias("start"), F.col("p.at").alias("at"), F.col("s.end").alias("end"),
                                      F.col("p.kind").alias("kind")).alias("s")))
    # one blob's spans: bounded by its text
    per_blob = one.groupBy("digest").agg(F.array_sort(F.collect_set("s")).alias("found"))
    kind = "array<struct<start:int, at:int, end:int, kind:string>>"
    return (common.join_back(addressed, per_blob, "digest")
            .withColumn("found", F.coalesce(F.col("found").cast(kind), F.array().cast(kind))))


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Bring the ledger up to the given versions and join its findings to them."""
    spark = versions.sparkSession
    addressed = common.keep(address(versions, text), "ledger-paths")
    update(versions, addressed, ledger, rules, text)
    return findings(addressed, read_ledger(spark, ledger), rules)


def compact(spark: SparkSession, ledger: str) -> None:
    """Write all finished runs as one, one row a blob; the old runs go afterwards.

    A crash in between leaves rows twice, which changes no result."""
    old = _runs(spark, ledger)
    if len(old) < 2:
        return
    rows = (read_ledger(spark, ledger).groupBy("digest")
            .agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
                 F.array_distinct(F.flatten(F.collect_list("found"))).alias("found")))
    rows.write.parquet(f"{ledger.rstrip('/')}/{common.new_name('run')}")
    for path in old:
        common.drop(spark, path)


def digests(found: DataFrame, rules: Sequence[Rule] = RULES, base: int = len(BASE)) -> DataFrame:
    """One row a document: counts of the base kinds and the spans in text form."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    basic = F.filter("found", lambda s: s["at"] < base)
    joined = lambda a: F.array_join(F.transform(a, text), ",")
    count = lambda i: F.size(F.filter("found", lambda s: s["at"] == i)).cast("long")
    return found.select(F.col("row.doc_id").alias("doc_id"), *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(rules[:base])],
                        F.sha2(joined(basic).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _re2(rule: Rule) -> str:
    """The pattern as RE2 reads it: letters in either case spelled out."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    pattern = rule.pattern
    for m in reversed(list(re.finditer(r"\(\?ai:(\([^)]*\)|[^)]*)\)", pattern))):
        pattern = pattern[:m.start()] + either(m.group(1)) + pattern[m.end():]
    return pattern.replace("'", "''")


def oracle_sql() -> str:
    """DuckDB SQL: matches are set between two marks and the text is cut there.

    The marks themselves are first replaced in the text by a third character, which
    no rule matches differently."""
    parts = []
    for at, r in enumerate(RULES):
        # the marked group: its length decides, the whole match gives the span
        size = f"length(regexp_extract(m, '{_re2(r)}', {r.group}))"
        parts.append(f"""
SELECT digest, {at} AS place, '{r.kind}' AS kind, start, start + length(m) AS stop FROM (
  SELECT digest, string_split(piece, chr(2))[1] AS m,
         CAST(sum(length(replace(piece, chr(2), ''))) OVER (PARTITION BY digest ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS start, i
  FROM (SELECT digest, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM (
          SELECT digest, string_split(regexp_replace(t, '({_re2(r)})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS pieces FROM blobs)))
WHERE i > 1 AND {size} >= {r.least}""")
    kinds = ", ".join(f"CAST(coalesce(len(list_filter(f.found, lambda s: s.place = {i})), 0) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(BASE))
    text = lambda a: f"coalesce(array_to_string(list_transform({a}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ','), '')"
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
a AS (SELECT doc_id, sha256(t) AS digest FROM d),
blobs AS (SELECT DISTINCT sha256(t) AS digest, t FROM d),
s AS ({' UNION ALL '.join(parts)}),
f AS (SELECT digest, list({{'start': start, 'place': place, 'stop': stop, 'kind': kind}} ORDER BY start, place) AS found FROM s GROUP BY digest)
SELECT a.doc_id, {kinds}, sha256({text(f"list_filter(f.found, lambda s: s.place < {len(BASE)})")}) AS base_sha256, {text("f.found")} AS spans
FROM a LEFT JOIN f ON a.digest = f.digest"""
