"""Model-response handling as column expressions (LLM4–LLM7, STR7).

JSON is parsed to VARIANT with full-text checks, so no Python runs per row:

* strict parse: ``try_parse_json`` alone accepts trailing text, so a text is
  taken as one JSON value only when both ``[text]`` and ``{"v":text}`` parse
  and the array has no second element;
* repair (only when the strict parse fails): the leftmost greedy
  ``{…}``/``[…]`` span, trailing commas before ``}``/``]`` dropped (also inside
  strings, as the reference does), then the strict parse again;
* a JSON ``null`` counts as no JSON.

Types are checked on the VARIANT (no coercion of numbers to strings), then
the typed values are read with ``from_json`` from the accepted text so map
keys keep their source order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablerail.functions.text import WS_CLASS, strip_ws

# The repair patterns.
JSON_SPAN = r"(?s)(\{.*\}|\[.*\])"
TRAILING_COMMA = r"," + WS_CLASS + r"*([}\]])"

SUMMARY_TYPE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("bullets", T.ArrayType(T.StringType())),
    T.StructField("key_points", T.ArrayType(T.StringType())),
    T.StructField("sections", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])

RESPONSE_TYPES = ("json", "str", "code", "tabular")
JSON_TYPES = ("web_summary", "generic")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def repaired_text(text: Column) -> Column:
    """The repair candidate: leftmost greedy object/array span, trailing commas removed."""
    span = F.regexp_extract(text, JSON_SPAN, 1)
    return F.when(span != "", F.regexp_replace(span, TRAILING_COMMA, "$1"))


def extract_json(df: DataFrame, text_col: str = "response", out: str = "payload") -> DataFrame:
    """LLM4: adds ``{out}`` (VARIANT, NULL = no JSON) and ``{out}_text`` (the accepted text).

    Each parse is a column of its own, so a long response is parsed once, and the
    repair is tried only where the text as it is does not parse."""
    t = _c(text_col)

    def parsed(d: DataFrame, text: Column, name: str) -> DataFrame:
        d = d.withColumns({"_a": F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))),
                           "_o": F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))})
        single = F.col("_a").isNotNull() & F.col("_o").isNotNull() & F.try_variant_get("_a", "$[1]", "variant").isNull()
        return d.withColumn(name, F.when(single, F.try_variant_get("_o", "$.v", "variant"))).drop("_a", "_o")

    d = parsed(df, t, "_direct").withColumn("_span", F.when(F.col("_direct").isNull(), repaired_text(t)))
    d = parsed(d, F.col("_span"), "_fixed")
    d = d.withColumn("_value", F.coalesce("_direct", "_fixed"))
    # JSON null: parse "succeeds" but yields nothing usable, and no repair is tried
    usable = F.col("_value").isNotNull() & ~F.is_variant_null("_value")
    accepted = F.when(F.col("_direct").isNotNull(), t).otherwise(F.col("_span"))
    return d.withColumns({f"{out}_text": F.when(usable, accepted), out: F.when(usable, F.col("_value"))}).drop(
        "_direct", "_span", "_fixed", "_value")


def variant_kind(v: Column) -> Column:
    """Top-level JSON kind: OBJECT, ARRAY, STRING, BIGINT, …"""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def response_error(payload: Column, expected: str = "json") -> Column:
    """LLM5: error text for a response of the expected type, NULL when fine."""
    if expected not in RESPONSE_TYPES:
        raise ValueError(f"unsupported response type: {expected!r}")
    if expected != "json":
        return F.lit(None).cast("string")
    kind = variant_kind(payload)
    return (F.when(payload.isNull(), F.lit("no_json"))
            .when(~kind.isin("OBJECT", "ARRAY"), F.lit("not_object_or_array")))


def _all_strings(arr: Column) -> Column:
    return F.coalesce(F.forall(arr, lambda x: F.schema_of_variant(x) == "STRING"), F.lit(True))


def summary_error(payload: Column) -> Column:
    """LLM6 (web_summary): NULL when the payload fits the summary shape, else the failing field."""
    kind = variant_kind(payload)
    title = F.try_variant_get(payload, "$.title", "variant")
    bullets = F.try_variant_get(payload, "$.bullets", "variant")
    kp = F.try_variant_get(payload, "$.key_points", "variant")
    sec = F.try_variant_get(payload, "$.sections", "variant")

    def is_null(v):
        return v.isNull() | F.is_variant_null(v)

    def str_list(v):
        arr = F.try_variant_get(v, "$", "array<variant>")
        return arr.isNotNull() & _all_strings(arr)

    sec_map = F.try_variant_get(sec, "$", "map<string,variant>")
    sec_ok = sec_map.isNotNull() & F.coalesce(F.forall(F.map_values(sec_map), lambda x: str_list(x)), F.lit(True))
    return (F.when(kind != "OBJECT", F.lit("not_object"))
            .when(~(is_null(title) | (F.schema_of_variant(title) == "STRING")), F.lit("title"))
            .when(~(bullets.isNull() | str_list(bullets)), F.lit("bullets"))
            .when(~(is_null(kp) | str_list(kp)), F.lit("key_points"))
            .when(~(is_null(sec) | sec_ok), F.lit("sections")))


def typed_summary(json_text: Column) -> Column:
    """Typed summary struct (bullets default to ``[]``) from accepted JSON text."""
    s = F.from_json(json_text, SUMMARY_TYPE)
    return F.struct(
        s["title"].alias("title"),
        F.coalesce(s["bullets"], F.array().cast(T.ArrayType(T.StringType()))).alias("bullets"),
        s["key_points"].alias("key_points"),
        s["sections"].alias("sections"),
    )


def summary_json(summary: Column) -> Column:
    """Validated object as compact JSON, NULL fields dropped (field order title, bullets, key_points, sections)."""
    return F.to_json(summary)


def _nonblank(x: Column) -> Column:
    return x.isNotNull() & (strip_ws(x) != "")


def _items(arr: Column, prefix: str) -> Column:
    return F.transform(F.filter(arr, _nonblank), lambda x: F.concat(F.lit(prefix), strip_ws(x)))


def _blank_if(cond: Column) -> Column:
    empty = F.array().cast(T.ArrayType(T.StringType()))
    return F.when(cond, F.array(F.lit(""))).otherwise(empty)


def summary_text(summary: Column) -> Column:
    """STR7: human-readable text: title, bullets and key points as ``- item``,
    sections as ``name:`` + ``  - item``; blank lines between; NULL when empty."""
    empty = F.array().cast(T.ArrayType(T.StringType()))
    title = summary["title"]
    title_lines = F.when(_nonblank(title), F.array(strip_ws(title), F.lit(""))).otherwise(empty)
    parts = [title_lines]
    for key in ("bullets", "key_points"):
        arr = F.coalesce(summary[key], empty)
        parts += [_items(arr, "- "), _blank_if(F.size(arr) > 0)]
    sections = F.coalesce(F.map_entries(summary["sections"]),
                          F.array().cast(T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                                                   T.StructField("value", T.ArrayType(T.StringType()))]))))
    sec_lines = F.flatten(F.transform(sections, lambda e: F.concat(
        F.when(_nonblank(e["key"]), F.array(F.concat(strip_ws(e["key"]), F.lit(":")))).otherwise(empty),
        _items(F.coalesce(e["value"], empty), "  - "),
        F.array(F.lit("")))))
    parts.append(sec_lines)
    text = strip_ws(F.array_join(F.concat(*parts), "\n"))
    return F.nullif(text, F.lit(""))


def validate_responses(df: DataFrame, text_col: str = "response", expected: str = "json",
                       json_type: str = "web_summary") -> DataFrame:
    """LLM4 → LLM5 → LLM6 → STR7 on a response column.

    Adds ``error`` (NULL = valid), ``summary_json`` and ``summary_text``.  For
    ``str`` and ``code`` the response itself is the text and any is valid; JSON
    checks apply to ``json`` only (tabular responses go to ``parse_tabular``)."""
    if json_type not in JSON_TYPES:
        raise ValueError(f"unsupported json_type: {json_type!r}")
    if expected not in RESPONSE_TYPES:
        raise ValueError(f"unsupported response type: {expected!r}")
    if expected != "json":
        none = F.lit(None).cast("string")
        return df.withColumns({"error": none, "summary_json": none, "summary_text": _c(text_col)})
    out = extract_json(df, text_col, "payload")
    err = response_error(F.col("payload"), expected)
    if json_type == "web_summary":
        err = F.coalesce(err, summary_error(F.col("payload")))
        typed = typed_summary(F.col("payload_text"))
        out = out.withColumn("error", err).withColumn("_summary", F.when(F.col("error").isNull(), typed))
        out = out.withColumns({"summary_json": summary_json(F.col("_summary")),
                               "summary_text": summary_text(F.col("_summary"))}).drop("_summary")
    else:
        out = out.withColumn("error", err).withColumn(
            "summary_json", F.when(F.col("error").isNull(), F.to_json(F.col("payload"))))
        out = out.withColumn("summary_text", F.lit(None).cast("string"))
    return out.drop("payload", "payload_text")


# A record: runs outside quotes and whole quoted strings, up to a line end.  A
# field: a quoted string ("" is a quote in it) or all up to the next comma.
CSV_RECORD = r'(?:[^"\r\n]++|"(?:[^"]++|"")*+"?+)++'


def csv_fields(record: Column) -> Column:
    """The fields of one CSV record, quotes resolved."""
    whole = F.regexp_extract_all(record, F.lit(r'(?:^|,)("(?:[^"]++|"")*+"[^,]*+|[^,]*+)'), F.lit(1))
    return F.transform(whole, lambda f: F.when(f.startswith('"'), F.replace(
        F.regexp_replace(f, r'(?s)^"((?:[^"]++|"")*+)".*$', "$1"), F.lit('""'), F.lit('"'))).otherwise(f))


def parse_tabular(df: DataFrame, text_col: str, schema: T.StructType | str, key_cols: tuple[str, ...] = ()) -> DataFrame:
    """LLM7: CSV text (header record first) → one row per data record.

    Columns go by the header's names (any order; a name of the schema that the
    header lacks is NULL); quoted fields may hold commas, quotes and line ends;
    blank lines count for nothing.  Output: key columns, ``line_no`` (record
    number from 1) and the fields; ``malformed`` marks records whose field count
    differs from the header's, or that hold a value not of its column's type."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    records = df.select(*key_cols, F.regexp_extract_all(_c(text_col), F.lit(CSV_RECORD), F.lit(0)).alias("_r"))
    records = records.select(*key_cols, F.transform(csv_fields(F.element_at("_r", 1)), lambda x: F.trim(x)).alias("_h"),
                             F.posexplode("_r").alias("line_no", "_line"))
    rows = records.where(F.col("line_no") > 0).withColumn("_v", csv_fields(F.col("_line")))
    values, bad = {}, F.size("_v") != F.size("_h")
    for f in st.fields:
        at = F.array_position("_h", f.name).cast("int")
        text = F.when(at > 0, F.nullif(F.try_element_at("_v", F.when(at > 0, at).otherwise(1)), F.lit("")))
        values[f.name] = text if isinstance(f.dataType, T.StringType) else F.trim(text).try_cast(f.dataType)
        bad = bad | (text.isNotNull() & values[f.name].isNull())
    return rows.select(*key_cols, "line_no", *[v.alias(k) for k, v in values.items()], F.coalesce(bad, F.lit(True)).alias("malformed"))
