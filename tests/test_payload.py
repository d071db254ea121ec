"""Response handling on the hand-written cases (FIXTURES.md §4)."""
import json

import pytest

from tablerail.functions.payload import parse_tabular, validate_responses

FENCE = "```"
CASES = [
    ('{"title":"T","bullets":["a","b"]}', None, {"title": "T", "bullets": ["a", "b"]}, "T\n\n- a\n- b"),
    ('Here you go:\n{"title":"T","bullets":["a","b",],}\nThanks', None, {"title": "T", "bullets": ["a", "b"]},
     "T\n\n- a\n- b"),
    (f'{FENCE}json\n{{"bullets":["a"]}}\n{FENCE}', None, {"bullets": ["a"]}, "- a"),
    ('{"bullets":["a"]} x', None, {"bullets": ["a"]}, "- a"),
    ('{"bullets":["a"]} {"bullets":["b"]}', "no_json", None, None),
    ('"x" {"bullets":["a"]}', None, {"bullets": ["a"]}, "- a"),
    ('[{"title":"T"}]', "not_object", None, None),
    ('[1] {"a":2}', "not_object", None, None),
    ("no json", "no_json", None, None),
    ("", "no_json", None, None),
    ("5", "not_object_or_array", None, None),
    ("null", "no_json", None, None),
    ("{'bullets':['a']}", "no_json", None, None),
    ('{"bullets":null}', "bullets", None, None),
    ('{"bullets":[1]}', "bullets", None, None),
    ('{"bullets":["a",null]}', "bullets", None, None),
    ('{"title":3}', "title", None, None),
    ('{"sections":{"a":null}}', "sections", None, None),
    ('{"x":1}', None, {"bullets": []}, None),
    ('{"title":null,"bullets":[]}', None, {"bullets": []}, None),
    ('{"title":" T ","bullets":[" ","b "],"key_points":["k"],"sections":{"z":["p",""],"a":[]}}', None,
     {"title": " T ", "bullets": [" ", "b "], "key_points": ["k"], "sections": {"z": ["p", ""], "a": []}},
     "T\n\n- b\n\n- k\n\nz:\n  - p\n\na:"),
    ('{"bullets":[],"key_points":null,"sections":{}}', None, {"bullets": [], "sections": {}}, None),
    ('x {"title":"q, }",}', None, {"title": "q}", "bullets": []}, "q}"),
]


@pytest.fixture(scope="module")
def validated(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, response string")
    return {r.id: r for r in validate_responses(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(validated, i):
    _, err, obj, text = CASES[i]
    r = validated[i]
    assert r.error == err
    if obj is None:
        assert r.summary_json is None
    else:
        assert json.loads(r.summary_json) == obj
        # key order of the stored JSON: title, bullets, key_points, sections; section order kept
        assert list(json.loads(r.summary_json)) == list(obj)
    assert r.summary_text == text


def test_section_order_kept(validated):
    assert list(json.loads(validated[20].summary_json)["sections"]) == ["z", "a"]


def test_unknown_types_raise(spark):
    df = spark.createDataFrame([(1, "{}")], "id int, response string")
    with pytest.raises(ValueError):
        validate_responses(df, json_type="recipe")
    with pytest.raises(ValueError):
        validate_responses(df, expected="xml")


def test_str_response_passes(spark):
    df = spark.createDataFrame([(1, "plain words")], "id int, response string")
    r = validate_responses(df, expected="str", json_type="generic").collect()[0]
    assert r.error is None


def test_tabular(spark):
    df = spark.createDataFrame([(1, "a,b\n1,x\n2,y,extra\n\n")], "id int, response string")
    rows = parse_tabular(df, "response", "a int, b string", ("id",)).orderBy("line_no").collect()
    assert [(r.a, r.b, r.malformed) for r in rows] == [(1, "x", False), (2, "y", True)]
