"""Text column functions (STR1–STR5, STR8–STR10), all JVM expressions."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail import schemas as S

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# The whitespace set of Python's ``str.split()``/``\s``, spelled out because
# Java's ``\s`` is ASCII-only (Java regex syntax; RE2 spelling in WS_CLASS_RE2).
WS_CHARS = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_CLASS = f"[{WS_CHARS}]"
NON_WS_CLASS = f"[^{WS_CHARS}]"
WS_CHARS_RE2 = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Cleaner patterns: JS fragment, script block, visible URL.
JS_FRAGMENT = r"requireLazy\([^)]+\)"
SCRIPT_BLOCK = r"(?s)<script[^>]*>.*?</script>"
URL_PATTERN = r"https?://" + NON_WS_CLASS + "+"
# Elements whose content is never visible text, and elements that break lines.
HIDDEN_ELEMENTS = ("head", "script", "style", "noscript", "template")
BLOCK_ELEMENTS = (
    "address", "article", "aside", "blockquote", "body", "br", "dd", "details", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table",
    "td", "th", "tr", "ul",
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of the full class."""
    return F.regexp_replace(_c(col), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def clean_page_text(col) -> Column:
    """STR1: drop JS fragments, script blocks and URLs, collapse whitespace, strip."""
    c = _c(col)
    c = F.regexp_replace(c, JS_FRAGMENT, "")
    c = F.regexp_replace(c, SCRIPT_BLOCK, "")
    c = F.regexp_replace(c, URL_PATTERN, "")
    c = F.regexp_replace(c, f"{WS_CLASS}+", " ")
    # after collapsing, only a single ASCII space can remain at either end
    return F.trim(c)


def strip_markup(col) -> Column:
    """STR2 without entity decoding: comments and hidden elements removed, block
    tags become a newline, all other tags vanish.

    Comments and hidden elements go in one left-to-right pass, so a "<!--" inside
    a script opens no comment and a "<script>" inside a comment no script."""
    c = _c(col)
    hidden = "|".join(rf"<{tag}\b[^>]*>.*?</{tag}\s*>" for tag in HIDDEN_ELEMENTS)
    c = F.regexp_replace(c, rf"(?is)<!--.*?-->|{hidden}", "")
    c = F.regexp_replace(c, r"(?i)</?(?:" + "|".join(BLOCK_ELEMENTS) + r")\b[^>]*>", "\n")
    c = F.regexp_replace(c, r"(?s)<[A-Za-z/!?][^>]*>", "")
    return c


# Frequent named references, decoded by plain replacement (their characters come
# from the standard HTML5 entity table).
COMMON_ENTITIES = ("lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "middot", "hellip", "mdash", "ndash",
                   "lsquo", "rsquo", "ldquo", "rdquo", "bull", "trade", "euro", "laquo", "raquo", "amp")
# Anything that can be a reference, as HTML5 reads it.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32}+;?)"


def _character(code: Column) -> Column:
    """The character of a numeric reference by the HTML5 rules: codes 128–159 mean
    Windows-1252, invalid ones U+FFFD, and control codes vanish."""
    windows = {c: bytes([c]).decode("cp1252") for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
    table = F.from_json(F.lit(json.dumps({str(k): v for k, v in windows.items()})), "map<string,string>")
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    # noncharacters, and control codes that are no white space
    gone = (code.between(1, 8) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF)
            | (code == 0xB) | (code % 0x10000).isin(0xFFFE, 0xFFFF))
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
            .when(code == 0xD, "\r").when(code.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
            .when(code.between(0x80, 0x9F), F.try_element_at(table, code.cast("string"))).when(gone, "").otherwise(text))


def _decoded(ref: Column) -> Column:
    """The text that one reference stands for (itself if it is none)."""
    names = F.from_json(F.lit(json.dumps(html5, ensure_ascii=False)), "map<string,string>")
    name = F.substr(ref, F.lit(2))
    # names that count without a semicolon, as the beginning of anything
    short = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    begin = F.regexp_extract(name, "^(" + "|".join(map(re.escape, short)) + ")", 1)
    by_begin = F.from_json(F.lit(json.dumps({n: html5[n] for n in short}, ensure_ascii=False)), "map<string,string>")
    digits = F.regexp_extract(name, "^#0*([0-9]*)", 1)
    hexes = F.regexp_extract(name, "^#[xX]0*([0-9a-fA-F]*)", 1)
    big = F.lit(0x110000).cast("long")
    decimal = F.when(F.length(digits) > 8, big).otherwise(F.coalesce(F.nullif(digits, F.lit("")), F.lit("0")).cast("long"))
    hexed = F.when(F.length(hexes) > 8, big).otherwise(F.conv(F.coalesce(F.nullif(hexes, F.lit("")), F.lit("0")), 16, 10).cast("long"))
    return (F.when(name.rlike("^#[xX]"), _character(hexed)).when(name.startswith("#"), _character(decimal))
            .otherwise(F.coalesce(F.try_element_at(names, name),
                                  F.concat(F.try_element_at(by_begin, begin), F.substr(name, F.length(begin) + 1)), ref)))


def unescape_entities(col) -> Column:
    """HTML character references → characters, with stdlib ``html.unescape`` rules.

    A row whose only references are common named ones is decoded by ``replace``
    (``&amp;`` last, so decoding stays single-pass).  In other rows the references
    are taken out, decoded one by one and put back between the text around them."""
    c = _c(col)
    simple = r"&(?:" + "|".join(COMMON_ENTITIES) + ");"
    others = F.regexp_replace(c, simple, "").contains("&")
    plain = c
    for name in COMMON_ENTITIES:
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(html5[f"{name};"]))
    parts = F.arrays_zip(F.split(c, REFERENCE, -1).alias("gap"), F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0)).alias("ref"))
    full = F.array_join(F.transform(parts, lambda x: F.concat(
        x["gap"], F.when(x["ref"].isNull(), "").otherwise(_decoded(x["ref"])))), "")
    return F.when(~c.contains("&"), c).when(~others, plain).otherwise(full)


def html_to_text(col) -> Column:
    """STR2: visible text of a page by fixed text rules (not a renderer: no CSS/JS).

    The input is referenced several times; on a DataFrame prefer
    ``with_page_text`` so the tag stripping runs once per row."""
    return unescape_entities(strip_markup(col))


def with_page_text(df, html_col: str = "html", out: str = "page_text"):
    """STR2 as two projections: markup stripped once, then entities decoded."""
    return df.withColumn(out, strip_markup(html_col)).withColumn(out, unescape_entities(out))


def normalize_tags(col, dtype: T.DataType | None = None) -> Column:
    """STR3: tags as list, CSV string, JSON-array text or NULL → trimmed non-blank array."""
    c = _c(col)
    if isinstance(dtype, T.ArrayType):
        arr = F.transform(c, lambda x: x.cast("string"))
    else:
        s = c.cast("string")
        as_json = F.from_json(s, T.ArrayType(T.StringType()))
        # text in brackets that is no JSON array ("[draft], bio") is CSV after all
        arr = F.when(F.regexp_like(s, F.lit(r"^\s*\[")), F.coalesce(as_json, F.split(s, ","))).otherwise(F.split(s, ","))
    trimmed = F.transform(arr, lambda x: strip_ws(x))
    return F.filter(trimmed, lambda x: x.isNotNull() & (x != ""))


def join_tags(arr) -> Column:
    """STR4: join with ``,``; empty or NULL → NULL."""
    a = _c(arr)
    return F.when(F.size(a) > 0, F.array_join(a, ","))


def url_domain(col="url") -> Column:
    """STR5: third ``/``-separated part of a URL (host[:port])."""
    return F.split_part(_c(col), F.lit("/"), F.lit(3))


def normalize_provider(col) -> Column:
    """STR8: lower/trim; a known provider or the default."""
    p = F.lower(strip_ws(_c(col)))
    return F.when(p.isin(*S.PROVIDERS), p).otherwise(F.lit(S.DEFAULT_PROVIDER))


def note_line(now_col: Column, note: str) -> Column:
    """``[YYYY-MM-DDTHH:MM:SS] note`` with the explicit clock."""
    return F.concat(F.lit("["), F.date_format(now_col, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("] " + note))


def prepend_note(notes_col, now_col: Column, note: str | None) -> Column:
    """STR9: new line on top of the old notes, stripped; no note → unchanged."""
    old = _c(notes_col)
    if not note:
        return old
    line = note_line(now_col, note)
    return F.when(old.isNull() | (old == ""), line).otherwise(
        F.regexp_replace(F.concat(line, F.lit("\n"), old), f"{WS_CLASS}+$", ""))


def cell_text(col, dtype: T.DataType) -> Column:
    """STR10: nested values → compact JSON text (non-ASCII kept), others → text."""
    c = _c(col)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def has_visible_text(col) -> Column:
    """Not NULL and not only whitespace (of the full class): one regex search
    that stops at the first visible character; NULL text gives false."""
    return F.coalesce(_c(col).rlike(NON_WS_CLASS), F.lit(False))
