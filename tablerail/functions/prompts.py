"""Prompt rendering (STR6): templates split once on the driver at their
placeholders, rendered per row with ``concat`` in the JVM (no ``format_string``:
a ``%`` in page text or template would break it)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Prompt templates (``str.format`` syntax: {name} placeholders,
# doubled braces stand for literal braces).
# ---------------------------------------------------------------------------
SUMMARIZE_TEXT_TEMPLATE = """
You are a concise, neutral summarization assistant.

Your task:
Summarize the following webpage into **3–6 bullet points** that capture the
main ideas, facts, and themes. Avoid filler language, avoid repetition, and do
not add commentary or interpretation. Focus strictly on what the page actually
says.

Webpage Information:
URL: {url}

CONTENT:
{content}

Instructions:
- Produce 3–6 short, information-rich bullet points.
- No preamble or explanation.
- No markdown fences.
- Only output the bullet points.
"""

SUMMARIZE_JSON_TEMPLATE = """
You are an expert analyst trained to convert webpage content into structured,
machine-readable JSON.

Your task:
Given the webpage content below, extract its essential meaning into a clean,
high-level JSON summary. Capture only what is present in the text—do not infer
details that the content does not support.

Webpage Information:
URL: {url}

CONTENT:
{content}

Output Format:
Return ONLY a valid JSON object (no comments, no markdown). The structure must be:

{{
  "title": "<short headline or null>",
  "bullets": [
    "Main idea #1",
    "Main idea #2",
    "Main idea #3"
  ],
  "key_points": [
    "Optional emphasized key takeaway #1",
    "Optional emphasized key takeaway #2"
  ],
  "sections": {{
    "section_name": [
      "Sub-point #1",
      "Sub-point #2"
    ],
    "another_section": [
      "Sub-point"
    ]
  }}
}}

Rules:
1. Use null for any field with no available information.
2. Do NOT use markdown formatting.
3. Do NOT invent content not supported by the text.
4. Ensure the JSON is syntactically valid.
"""

EXTRACT_TITLE_TEMPLATE = """
You are given raw webpage content. Extract the **best possible short title** that
represents the main subject of the page.

CONTENT:
{content}

Output:
Return ONLY the title as a single plain-text line. No quotes, no markdown.
"""

EXTRACT_HEADINGS_TEMPLATE = """
Extract the top 3–5 conceptual headings from the following webpage text.
These are not HTML headings, but human-level major themes.

CONTENT:
{content}

Output:
Return a plain-text list, one heading per line, NO numbering, NO markdown.
"""

TEMPLATES = {
    "summary_text": SUMMARIZE_TEXT_TEMPLATE,
    "summary_json": SUMMARIZE_JSON_TEMPLATE,
    "title": EXTRACT_TITLE_TEMPLATE,
    "headings": EXTRACT_HEADINGS_TEMPLATE,
}

_FIELD = re.compile(r"\{\{|\}\}|\{([A-Za-z_][A-Za-z0-9_]*)\}")


def template_parts(template: str) -> list[tuple[str, str]]:
    """Split a ``str.format`` template into ("lit", text) and ("field", name) parts."""
    parts: list[tuple[str, str]] = []
    buf, pos = [], 0
    for m in _FIELD.finditer(template):
        buf.append(template[pos:m.start()])
        if m.group(0) == "{{":
            buf.append("{")
        elif m.group(0) == "}}":
            buf.append("}")
        else:
            parts.append(("lit", "".join(buf)))
            buf = []
            parts.append(("field", m.group(1)))
        pos = m.end()
    buf.append(template[pos:])
    parts.append(("lit", "".join(buf)))
    return [p for p in parts if p != ("lit", "")]


def render(template: str, **fields: Column | str) -> Column:
    """Render ``template`` per row; each placeholder takes a Column (or column name)."""
    cols = []
    for kind, val in template_parts(template):
        if kind == "lit":
            cols.append(F.lit(val))
        else:
            if val not in fields:
                raise KeyError(f"template needs field {val!r}")
            f = fields[val]
            cols.append(F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")))
    return F.concat(*cols)


def render_sql(template: str, **fields: str) -> str:
    """The same rendering as a SQL ``concat`` (for the oracle)."""
    out = []
    for kind, val in template_parts(template):
        if kind == "lit":
            out.append("'" + val.replace("'", "''") + "'")
        else:
            out.append(f"coalesce(CAST({fields[val]} AS VARCHAR), '')")
    return "concat(" + ", ".join(out) + ")"
