"""Cleaning, tags, coercion and date cases (FIXTURES.md §5)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablerail.functions import coerce as CO
from tablerail.functions import text as TX
from tablerail.functions.prompts import SUMMARIZE_JSON_TEMPLATE, render, template_parts

NBSP, EMSP = "\u00a0", "\u2003"


def _one(spark, col_fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.o for r in df.select("i", col_fn(F.col("v")).alias("o")).orderBy("i").collect()]


STR1_CASES = [
    ("a requireLazy([1,2]) b", "a b"),
    ("a requireLazy(f(x)) b", "a ) b"),
    ("requireLazy()", "requireLazy()"),
    ("x<script t>1\n2</script>y<script>3</script>z", "xyz"),
    ("<SCRIPT>1</SCRIPT>", "<SCRIPT>1</SCRIPT>"),
    ("see https://a.b/c?d=1, now", "see now"),
    ("http://a" + NBSP + "b", "b"),
    ("a" + NBSP + EMSP + "\t\n\x1c b \n c", "a b c"),
    ("https://only.url", ""),
]


def test_str1_cases(spark):
    got = _one(spark, TX.clean_page_text, [c[0] for c in STR1_CASES])
    assert got == [c[1] for c in STR1_CASES]


def test_str1_matches_python_whitespace(spark):
    import re
    chars = [chr(c) for c in range(0, 0x3100) if chr(c).isspace()]
    s = "a" + "".join(chars) + "b" + chars[0] + "c"
    want = re.sub(r"\s+", " ", s).strip()
    assert _one(spark, TX.clean_page_text, [s]) == [want]


def test_html_to_text(spark):
    html = ("<html><head><title>T</title><style>p{}</style></head><body><!-- c --><p>A &amp; B</p>"
            "<script>var x='<p>';</script><div>C&nbsp;D &#233;</div><b>E</b>F</body></html>")
    got = _one(spark, lambda c: TX.clean_page_text(TX.html_to_text(c)), [html])
    assert got == ["A & B C D é EF"]


def test_tags(spark):
    got = _one(spark, lambda c: TX.join_tags(TX.normalize_tags(c)),
               ['["a"," ","b "]', "biology, amphibians, mexican", None, "[]"])
    assert got == ["a,b", "biology,amphibians,mexican", None, None]


def test_domain_and_provider(spark):
    assert _one(spark, TX.url_domain, ["https://x.org/a/b", "nohost"]) == ["x.org", ""]
    assert _one(spark, TX.normalize_provider, [" Anthropic ", "bard", None]) == ["anthropic", "openai", "openai"]


def test_co1(spark):
    vals = ["0", "1.0", "abc", None, "2.9", "-2.9", " 7 ", "1e3", "nan", "inf", ""]
    assert _one(spark, CO.coerce_iteration, vals) == [0, 1, 0, 0, 2, -2, 7, 1000, 0, 0, 0]


def test_co4(spark):
    vals = ["done", "COMPLETED", "skipped", "running", "Retry", "abandoned", "", None, "paused", "foo"]
    got = _one(spark, lambda c: CO.coerce_task_state(c, F.lit("NEW")), vals)
    assert got == ["HOLD", "HOLD", "SKIP", "READY", "READY", "READY", "READY", "READY", "PAUSED", "FOO"]
    for st in ("COMPLETED", "SKIPPED"):
        assert _one(spark, lambda c: CO.coerce_task_state(c, F.lit(st)), ["", None]) == ["HOLD", "HOLD"]


def test_co5(spark):
    vals = ["true", "Y", "2", "0", "no", "2.0", "maybe", None]
    assert _one(spark, CO.coerce_claimed, vals) == [True, True, True, False, False, False, False, False]


def test_dt3(spark):
    vals = ["2024-01-02", "Jan 02, 2024", "January 2, 2024", "02/01/2024", "soon"]
    d = dt.date(2024, 1, 2)
    assert _one(spark, CO.parse_date, vals) == [d, d, d, None, None]


def test_prompt_render(spark):
    got = _one(spark, lambda c: render(SUMMARIZE_JSON_TEMPLATE, url=F.lit("u%s"), content=c), ["body {x} 100%"])
    assert got == [SUMMARIZE_JSON_TEMPLATE.format(url="u%s", content="body {x} 100%")]
    assert ("field", "url") in template_parts(SUMMARIZE_JSON_TEMPLATE)


def test_prepend_note(spark):
    from tablerail.session import ts
    got = _one(spark, lambda c: TX.prepend_note(c, ts("2024-01-15 00:00:00"), "n"), [None, "", "old \n"])
    assert got == ["[2024-01-15T00:00:00] n", "[2024-01-15T00:00:00] n", "[2024-01-15T00:00:00] n\nold"]


@pytest.mark.parametrize("bad", ["{missing}"])
def test_render_missing_field(bad):
    with pytest.raises(KeyError):
        render(bad)


def test_unescape_matches_stdlib(spark):
    import html
    cases = ["&amp;lt;", "&copy", "&#233;&#x41;", "&unknown; &amp;", "&amp;amp;", "a & b", "&nbsp;x&hellip;",
             "&lt;p&gt;", "plain", None, "&AMP;", "&ampx;", "&#0;", "&#128;"]
    got = _one(spark, TX.unescape_entities, cases)
    assert got == [None if c is None else html.unescape(c) for c in cases]


def test_references_decode_like_the_standard_library(spark):
    import html
    import random
    cases = ["a &amp b", "&notit; &notin;", "&#65;&#x42;&#X43; &#99", "&#0; &#128; &#x81; &#55296; &#1114112; &#99999999999;", "&#11;x&#13;y&#xFFFF;",
             "&amp;lt; &amp;amp;", "&nosuch; &; & &# &#; &#x;", "&copy2024 &COPY; &AElig &ampx;y", "&fjlig; &NotEqualTilde;", "&#x1F600; \U0001f600 é &eacute;",
             "&lt;&gt &quot", "&CounterClockwiseContourIntegral;", "&" * 50, "&ampamp;", "x&#xA0;y&#160;z", "&#159; &#150;"]
    rng = random.Random(1)
    bits = ["&", "amp", ";", "#", "x", "41", "lt", "not", "in", " ", "é", "8364", "a", "&#", "&#x"]
    cases += ["".join(rng.choice(bits) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r.i: r.o for r in df.select("i", TX.unescape_entities("t").alias("o")).collect()}
    bad = [(t, html.unescape(t), got[i]) for i, t in enumerate(cases) if got[i] != html.unescape(t)]
    assert not bad, bad[:5]


def test_page_text_runs_no_python(spark):
    from conftest import SF001
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    plan = TX.with_page_text(pages)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_comments_and_scripts_in_one_pass(spark):
    cases = ['<script>var a="<!--";</script><p>KEEP ME</p><!-- c --><p>tail</p>', "<!-- <script> --><p>a</p><script>x</script>", "<style>p{}</style>b"]
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    got = [r.t for r in TX.with_page_text(df, "h", "t").select(TX.clean_page_text("t").alias("t")).collect()]
    assert got == ["KEEP ME tail", "a", "b"]


def test_bracketed_csv_tags(spark):
    df = spark.createDataFrame([("[draft], bio",), ('["a"," "]',), ("[]",)], "t string")
    assert [r.t for r in df.select(TX.join_tags(TX.normalize_tags("t")).alias("t")).collect()] == ["[draft],bio", "a", None]
