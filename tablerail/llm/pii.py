"""Personal data: candidate spans, boosted trees, calibrated thresholds.

All of it is SQL expressions; no Python runs on the executors.  Base spans come
from fixed patterns and checks and always stay.  Beside them, wider generators
per kind propose spans that may overlap base spans and each other (addresses
written with "at" and "dot", numbers in national format, numbers of other
lengths or with odd separators).  Each proposal gets format features (style,
digits, separators, length, sign) and context features (the characters around it,
a telling word before it).

What trees learn is whether a proposal is personal data, and the label is evidence
that the features do not hold: brought into the plain form ("at", "dot", brackets,
blanks and the country prefix taken away) it passes the check of its kind, i.e. a
known top-level domain, parts up to 255, Luhn and brand, an area code.  Figures
pass by chance now and then, personal data always, so the share that passes among
proposals written alike, in a like context, tells the two apart.  Boosted trees of
depth two estimate that share from counts per combination of features.  They are
fitted on the proposals of all documents; one fold of them trains, the other
calibrates (isotonic: shares fall with the score): a kind's threshold is the last
score at which the share still reaches the precision.
Proposals above it that pass the check are added unless they lie within a base
span, so a span may extend one of the base.

The patterns use possessive quantifiers and start only where a leftmost match
can, so very long runs of one character class take linear time and no stack.

Defined results: a null text counts as empty and has no span; spans count code
points, the end is exclusive; whole texts are searched.  Rows that repeat or
have null ids are handled each on its own.  An empty table trains nothing and
gives an empty result.  Other columns are left as they are."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# \G: right after the last match; else not inside a run that an earlier start had
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a chain of digits with single separators is one match; those of other lengths fail
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    # a plain dot has blanks on both sides or none, so a sentence's end is no dot
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?(?:@|[(\[](?i:at)[)\]])\x20?|\x20(?i:at)\x20)[A-Za-z0-9-]{1,63}+"
              r"(?:(?:\.|\x20\.\x20|\x20?[(\[](?:(?i:dot)|\.)[)\]]\x20?|\x20(?i:dot)\x20)[A-Za-z0-9-]{1,63}+){1,6}+"),
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?(?:\.|\[\.\]|\(\.\))\x20?[0-9]{1,3}+){3}+(?![0-9.]*[0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]{0,2}[0-9]){12,18}+(?![0-9])",
    "phone": (r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-]{0,2})?\(?[0-9]{3}(?:\)[\x20./-]{0,2}|[\x20./-]{1,2})"
              r"[0-9]{3}[\x20./-]{1,2}[0-9]{4}(?![0-9])"),
}
# a cheap test that a text can hold a match at all
GUARD = {
    "email": r"@|[\x20(\[](?i:at)[\x20)\]]",
    "ip": r"[0-9][\x20\[(]{0,2}\.", "card": r"[0-9][\x20.-]{0,2}[0-9][\x20.-]{0,2}[0-9]",
    "phone": r"[0-9][\x20().0-9/-]{5}",
}
# Top-level domains that addresses in prose commonly have.
TOP_LEVEL = "com|org|net|edu|gov|mil|int|info|biz|name|io|dev|app|eu|uk|us|ca|au|de|fr|es|it|nl|ch|at|se|no|pl|pt|br|jp|cn|in|ru"
DOMAIN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?i:" + TOP_LEVEL + ")$"
BRAND = r"^(?:4[0-9]{12}|3[0689][0-9]{12}|3[47][0-9]{13}|[2-6][0-9]{15,18})$"
NATIONAL = r"^1?[2-9][0-9]{2}[2-9][0-9]{6}$"
# groups as cards show them, with one separator throughout, or none
GROUPS = (r"^[0-9]{13,19}$|^[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?$"
          r"|^[0-9]{4}([\x20.-])[0-9]{6}\2[0-9]{4,5}$")
CALLED = (r"^(?:1[\x20.-]?)?\([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}$|^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$"
          r"|^1([.-])[0-9]{3}\2[0-9]{3}\2[0-9]{4}$")
CONTEXT = {
    "email": "(?i)mail|contact|write", "ip": "(?i)ip|host|address|server", "card": "(?i)card|visa|credit|pay",
    "phone": "(?i)tel|phone|call|mobile|fax",
}
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SPAN = "struct<kind:int,start:int,end:int>"
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column) -> Column:
    """Consecutive runs of BLOCK items (``items`` must be a bound value)."""
    n = F.ceil(F.size(items) / BLOCK).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))).otherwise(
        F.slice(F.array(items), 1, 0))


def found(text: Column, pattern: str) -> Column:
    """array<struct<start,end,m>> of all matches.

    The gaps that ``split`` leaves and the matches alternate, so their lengths
    add up to positions; sums run block by block, so the work stays linear."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = F.filter(F.arrays_zip(matches.alias("m"), gaps.alias("g")), lambda x: x["m"].isNotNull())

    def place(z: Column) -> Column:
        def offsets(blocks: Column) -> Column:
            sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + F.length(x["g"]) + F.length(x["m"])))
            return F.aggregate(sums, F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))

        def within(pair: Column) -> Column:
            empty = F.array().cast("array<struct<start:int,end:int,m:string>>")
            return F.aggregate(
                pair["b"], F.struct(pair["o"].alias("pos"), empty.alias("out")),
                lambda acc, x: F.struct(
                    (acc["pos"] + F.length(x["g"]) + F.length(x["m"])).alias("pos"),
                    F.concat(acc["out"], F.array(F.struct(
                        (acc["pos"] + F.length(x["g"])).alias("start"),
                        (acc["pos"] + F.length(x["g"]) + F.length(x["m"])).alias("end"), x["m"].alias("m")))).alias("out")),
                lambda acc: acc["out"])

        def all_blocks(blocks: Column) -> Column:
            zipped = F.filter(F.arrays_zip(blocks.alias("b"), offsets(blocks).alias("o")), lambda x: x["b"].isNotNull())
            return F.flatten(F.transform(zipped, within))

        return let(_blocks(z), all_blocks)

    return let(parts, place)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits pass the Luhn check (every second one from the right doubled)."""
    def total(d: Column) -> Column:
        def add(s: Column, i: Column) -> Column:
            v = F.substr(d, i, F.lit(1)).cast("int")
            twice = (F.length(d) - i) % 2 == 1
            return s + F.when(twice & (v > 4), v * 2 - 9).when(twice, v * 2).otherwise(v)
        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0
    return let(digits_of(m), total)


def valid(kind: str, m: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        return m.rlike(f"^{IP_PART}(?:\\.{IP_PART}){{3}}$")
    if kind == "card":
        return F.length(digits_of(m)).between(16, 19) & luhn(m)
    if kind == "phone":
        return F.length(digits_of(m)).between(8, 15)
    return F.lit(True)


def _guarded(text: Column, kind: str, pattern: str) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,m:string>>")
    return F.when(text.rlike(GUARD[kind]), found(text, pattern)).otherwise(none)


def base_spans(text: Column) -> Column:
    """array<SPAN> of the base, by kind as listed, then start."""
    def of(kind: str, n: int) -> Column:
        checked = F.filter(_guarded(text, kind, BASE[kind]), lambda x: valid(kind, x["m"]))
        return F.transform(checked, lambda x: F.struct(F.lit(n).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return F.concat(*[of(kind, n) for n, kind in enumerate(KINDS)])


# --------------------------------------------------------------------- candidates

# of equally good splits the first feature's is taken
FEATURES = ("style", "digits", "separators", "length", "sign", "before", "after", "telling")


def checked(kind: str, m: Column) -> Column:
    """The check of a candidate, brought into the plain form first."""
    if kind == "email":
        at = F.regexp_replace(m, r"\x20?(?:@|[(\[](?i:at)[)\]])\x20?|\x20(?i:at)\x20", "@")
        return F.regexp_replace(at, r"\x20\.\x20|\x20?[(\[](?:(?i:dot)|\.)[)\]]\x20?|\x20(?i:dot)\x20", ".").rlike(DOMAIN)
    if kind == "ip":
        return F.regexp_replace(m, r"[\x20\[\]()]", "").rlike(f"^{IP_PART}(?:\\.{IP_PART}){{3}}$")
    if kind == "card":
        return digits_of(m).rlike(BRAND) & luhn(m)
    return F.when(m.startswith("+") & ~digits_of(m).startswith("1"), F.length(digits_of(m)).between(8, 15)).otherwise(digits_of(m).rlike(NATIONAL))


def style(kind: str, m: Column) -> Column:
    """How a candidate is written: 0 plainly, 1 otherwise but unmistakably, 2 in a way
    that prose and figures share, 3 across the end of a plain one."""
    if kind == "email":
        marked = m.rlike(r"(?i)[(\[](?:at|dot|\.)[)\]]|\x20dot\x20")
        return (F.when(~m.rlike(r"[\x20(\[]"), 0).when(m.rlike(r"[^\x20]@[^\x20].*\x20\.\x20"), 3)
                .when(m.rlike(r"\x20@|@\x20|\x20\.\x20"), 2).when(marked, 1).otherwise(2))
    if kind == "ip":
        return F.when(m.rlike(r"^[0-9.]+$"), 0).when(m.rlike(r"[\[(]"), 1).otherwise(2)
    if kind == "card":
        return F.when(m.rlike(GROUPS), F.when(m.contains("."), 1).otherwise(0)).otherwise(2)
    return F.when(m.startswith("+"), 0).when(m.rlike(CALLED), 1).otherwise(2)


def _character(c: Column) -> Column:
    """Class of a neighbouring character: none, blank, letter, digit, other."""
    return (F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3).otherwise(4))


def candidates(text: Column) -> Column:
    """array of struct(kind, start, end, features..., passes, fold): all proposals."""
    def described(kind: str, n: int) -> Column:
        def one(x: Column) -> Column:
            digits = F.length(digits_of(x["m"]))
            marks = F.length(F.regexp_replace(x["m"], r"[A-Za-z0-9]", ""))
            left = F.substr(text, F.greatest(x["start"] - 23, F.lit(1)), F.least(x["start"], F.lit(24)))
            return F.struct(
                F.lit(n).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                F.least(digits, F.lit(20)).alias("digits"), F.least(marks, F.lit(8)).alias("separators"),
                F.least(F.floor((x["end"] - x["start"]) / 4).cast("int"), F.lit(10)).alias("length"),
                x["m"].startswith("+").cast("int").alias("sign"),
                _character(F.when(x["start"] > 0, F.substr(text, x["start"], F.lit(1))).otherwise("")).alias("before"),
                _character(F.substr(text, x["end"] + 1, F.lit(1))).alias("after"),
                left.rlike(CONTEXT[kind]).cast("int").alias("telling"),
                style(kind, x["m"]).alias("style"), checked(kind, x["m"]).alias("passes"),
                (F.crc32(x["m"].cast("binary")) % 2).cast("int").alias("fold"))
        return F.transform(_guarded(text, kind, WIDE[kind]), one)
    return F.concat(*[described(k, n) for n, k in enumerate(KINDS)])


def _within(spans: Column, c: Column) -> Column:
    """Whether a span of any kind holds the whole candidate."""
    return F.exists(spans, lambda s: (s["start"] <= c["start"]) & (c["end"] <= s["end"]))


# ------------------------------------------------------------------ boosted trees

@dataclass
class Trees:
    """Per kind: a start value, trees ((feature, level, left, right) or a leaf)
    and the calibrated threshold of the score (None: nothing is added)."""
    start: dict[int, float] = field(default_factory=dict)
    trees: dict[int, list] = field(default_factory=dict)
    threshold: dict[int, float | None] = field(default_factory=dict)

    def expression(self, c: Column) -> Column:
        """Whether candidate ``c`` is selected, as a SQL expression."""
        def value(node: tuple | float) -> Column:
            if not isinstance(node, tuple):
                return F.lit(node)
            name, level, left, right = node
            return F.when(c[name] <= level, value(left)).otherwise(value(right))
        chosen = F.lit(False)
        for kind, limit in self.threshold.items():
            if limit is not None:
                score = F.lit(self.start[kind])
                for t in self.trees[kind]:
                    score = score + value(t)
                chosen = chosen | ((c["kind"] == kind) & (score >= limit))
        return chosen


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, depth: int, rate: float) -> tuple | float:
    """A regression tree on gradient sums ``g`` and weights ``h`` of the cells."""
    leaf = float(rate * g[at].sum() / (h[at].sum() + 1.0))
    if depth == 0 or len(at) < 2:
        return leaf
    best, gain = None, 1e-6
    whole = g[at].sum() ** 2 / (h[at].sum() + 1.0)
    for f in range(x.shape[1]):
        for level in np.unique(x[at, f])[:-1]:
            low = x[at, f] <= level
            a, b = at[low], at[~low]
            score = g[a].sum() ** 2 / (h[a].sum() + 1.0) + g[b].sum() ** 2 / (h[b].sum() + 1.0) - whole
            if score > gain:
                best, gain = (f, int(level), a, b), score
    if best is None:
        return leaf
    f, level, a, b = best
    return (FEATURES[f], level, _grow(x, g, h, a, depth - 1, rate), _grow(x, g, h, b, depth - 1, rate))


def _apply(node: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(node, tuple):
        return np.full(len(x), node)
    name, level, left, right = node
    return np.where(x[:, FEATURES.index(name)] <= level, _apply(left, x), _apply(right, x))


def boost(cells: list[dict], rounds: int = 25, rate: float = 0.3, precision: float = 0.9, support: int = 5) -> Trees:
    """Trees and thresholds from counted feature cells: kind, features, fold, n,
    positive, and of both those outside the base spans (n_new, positive_new).
    Fold 0 trains, fold 1 calibrates."""
    out = Trees()
    for kind in range(len(KINDS)):
        own = sorted((c for c in cells if c["kind"] == kind), key=lambda c: [c[f] for f in (*FEATURES, "fold")])
        if not own:
            continue
        x = np.array([[c[f] for f in FEATURES] for c in own])
        n, pos, n_new, pos_new = (np.array([float(c[k]) for c in own]) for k in ("n", "positive", "n_new", "positive_new"))
        train = np.array([c["fold"] == 0 for c in own])
        if pos[train].sum() < support:
            continue
        share = np.clip(pos[train].sum() / n[train].sum(), 1e-3, 1 - 1e-3)
        out.start[kind], out.trees[kind] = math.log(share / (1 - share)), []
        z = np.full(len(own), out.start[kind])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-z))
            tree = _grow(x, (pos - n * p) * train, n * p * (1 - p) * train, np.flatnonzero(train), 2, rate)
            out.trees[kind].append(tree)
            z += _apply(tree, x)
        out.threshold[kind] = None
        held = ~train
        groups = []
        for limit in sorted(set(z[held].round(9)), reverse=True):
            same = held & (z.round(9) == limit)
            groups.append([float(limit), *(float(v[same].sum()) for v in (n, pos, n_new, pos_new))])
        seen = seen_new = right_new = 0.0
        for limit, k, right, k_new, r_new in _isotonic(groups):
            seen, seen_new, right_new = seen + k, seen_new + k_new, right_new + r_new
            if right < precision * k or right_new < precision * seen_new:
                break
            if seen >= support:
                out.threshold[kind] = limit - 1e-6
    return out


def _isotonic(groups: list[list[float]]) -> list[list[float]]:
    """Neighbouring groups (lowest score, n, positive, …) pooled until the share of
    positives falls with the score, as a calibrated probability does."""
    out: list[list[float]] = []
    for g in groups:
        out.append(g)
        while len(out) > 1 and out[-1][2] * out[-2][1] > out[-2][2] * out[-1][1]:
            low = out.pop()
            out[-1] = [low[0], *(a + b for a, b in zip(out[-1][1:], low[1:], strict=True))]
    return out


def train(docs: DataFrame, sample: int | None = None) -> Trees:
    """Trees from the proposals of every document.  Cells of equal features are
    counted on the executors; the features have few values each, so the number of
    cells has a bound that the documents do not move.

    ``sample``: for a caller that asks for it, about so many documents, chosen by a
    hash of id and text (all, if there are fewer)."""
    total = docs.count() if sample is not None else 0
    if sample is not None and total > sample:
        part = F.pmod(F.xxhash64(F.lit(9), "doc_id", "text"), F.lit(1_000_000))
        docs = docs.where(part < int(1_000_000 * sample / total) + 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spans = docs.select(text.alias("text")).select("text", base_spans(F.col("text")).alias("base"),
                                                   candidates(F.col("text")).alias("c")).where(F.size("c") > 0)
    marked = spans.select(F.explode(F.transform("c", lambda c: F.struct(
        c.alias("c"), c["passes"].cast("int").alias("y"), (~_within(F.col("base"), c)).cast("int").alias("new")))).alias("e"))
    cells = (marked.groupBy(*[F.col(f"e.c.{f}").alias(f) for f in ("kind", *FEATURES, "fold")])
             .agg(F.count("*").alias("n"), F.sum("e.y").alias("positive"),
                  F.sum("e.new").alias("n_new"), F.sum(F.col("e.y") * F.col("e.new")).alias("positive_new")))
    return boost([r.asDict() for r in cells.collect()])


# ------------------------------------------------------------------------- results

def with_spans(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with __base and __all, arrays of SPAN in order of kind and start; the
    callers see to it that ``docs`` has no such columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn("__base", base_spans(text))
    if not any(v is not None for v in trees.threshold.values()):
        return df.withColumn("__all", F.col("__base"))
    picked = F.filter(candidates(text), lambda c: c["passes"] & trees.expression(c) & ~_within(F.col("__base"), c))
    added = F.transform(picked, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return df.withColumn("__added", added).withColumn("__all", F.array_sort(F.array_union("__base", "__added"))).drop("__added")


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256 and all spans."""
    df = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), trees)

    def count(n: int) -> Column:
        return F.size(F.filter("__base", lambda s: s["kind"] == n)).cast("long")

    return df.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)], F.sha2(_joined("__base").cast("binary"), 256).alias("base_sha256"),
                     _joined("__all").alias("spans"))


def redact(docs: DataFrame, trees: Trees, length_column: str | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets;
    overlapping spans become one tag, that of the first.  ``length_column``, if
    there, is set to the new number of characters of changed texts.  Other texts,
    null ones too, and all other columns stay as they are."""
    # the caller's columns travel in one struct: their names never meet ours
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    df = with_spans(docs.select(row, F.col("text")), trees)
    in_order = F.array_sort(F.transform("__all", lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def rebuilt(spans: Column) -> Column:
        # how far the text is covered before each span: a running maximum of ends
        def reach(blocks: Column) -> Column:
            tops = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: -s["back"])))
            return F.aggregate(tops, F.array(F.lit(0)), lambda a, m: F.concat(a, F.array(F.greatest(F.element_at(a, -1), m))))

        def piece(pair: Column) -> Column:
            step = lambda acc, s: F.struct(
                F.greatest(acc["pos"], -s["back"]).alias("pos"),
                F.concat(acc["out"], F.array(F.when(s["start"] >= acc["pos"], F.concat(
                    F.substr(F.col("text"), acc["pos"] + 1, s["start"] - acc["pos"]),
                    F.element_at(tags, s["kind"] + 1))).otherwise(""))).alias("out"))
            return F.aggregate(pair["b"], F.struct(pair["o"].alias("pos"), F.array().cast("array<string>").alias("out")), step,
                               lambda acc: acc["out"])

        def whole(blocks: Column) -> Column:
            zipped = F.filter(F.arrays_zip(blocks.alias("b"), reach(blocks).alias("o")), lambda x: x["b"].isNotNull())
            end = F.array_max(F.transform(spans, lambda s: -s["back"]))
            return F.concat(F.array_join(F.flatten(F.transform(zipped, piece)), ""),
                            F.substr(F.col("text"), end + 1, F.length("text")))

        return let(_blocks(spans), whole)

    new = F.when(F.size("__all") > 0, let(in_order, rebuilt)).otherwise(F.col("text"))
    df = df.select("row", new.alias("text"), (F.size("__all") > 0).alias("changed"))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("text")
        old = F.col("row")[c]
        if c == length_column:
            return F.when(F.col("changed"), F.length("text").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)
    return df.select(*[column(c) for c in docs.columns])
