"""Seed files read in byte ranges give what reading them whole gives."""
import json
import os
import random

import pytest

from tablerail.sources import json_split as J
from tablerail.sources import seeds


def whole(text):
    """(entries, reason) by reading the file at once."""
    try:
        doc = json.loads(text.removeprefix("﻿"), parse_constant=lambda c: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return [], J.NO_JSON
    if isinstance(doc, dict) and isinstance(doc.get("urls"), list):
        doc = doc["urls"]
    return (doc, None) if isinstance(doc, list) else ([], J.NO_LIST)


def entry(rng):
    tricky = ["}", "{", "]", "[", '"', "\\", ",", ":", "é", "urls", '"urls": [', "\n", "}}", "x" * 30, " "]
    text = lambda: "".join(rng.choice(tricky) for _ in range(rng.randint(0, 6)))
    kind = rng.randrange(9)
    if kind == 0:
        return rng.choice([5, None, True, "plain", "", 1.5, [], [1, {"a": 2}], {}, {"urls": [1]}])
    e = {"url": f"https://{rng.randrange(10**6)}.example/{text()}"}
    if kind > 4:
        e["source"] = text()
    if kind > 6:
        e["tags"] = rng.choice([["a", text()], "a, b", {"deep": [{"urls": [{"url": "no"}]}]}])
    return e


def dump(rng, doc):
    return json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]))


def files(rng, size):
    for _ in range(size):
        items = [entry(rng) for _ in range(rng.choice([0, 1, 2, 5, 40, 100]))]
        other = {f"k{i}": rng.choice([1, "}", {"urls": [{"url": "inner"}]}, [[{}]], [{"a": "]"}] * 20]) for i in range(rng.randint(0, 3))}
        doc = rng.choice([items, items, {"urls": items}, {**other, "urls": items}, {"urls": items, **other}, {**other, "links": items}])
        yield dump(rng, doc)
    good = dump(rng, [entry(rng) for _ in range(50)])
    wrapped = dump(rng, {"urls": [{"url": "a"}, {"url": "b"}]})
    for t in (good, wrapped):
        yield from (t[:-1], t[:-4], t[:len(t) // 2], t + "}", t + "]", t + " x", t + "\n \t", "﻿" + t, "[" + t + "]", t.replace("{", "", 1), t + t, "," + t)
    yield from ('[{"a": 1} {"b": 2}]', '[{"a": 1},, {"b": 2}]', '[{"a": 1},]', "[,1]", '[{"a": 1}, ]', "[]", "{}", '{"urls": []}', '{"urls": {}}',
                '{"urls": 3}', "7", '"}"', "null", " ", "}", "]", "{", "[", "{}{}", '{"urls": [1, 2], "urls2": [{"url": "x"}]}', "not json } at all }",
                '[1, 2, {"url": "u"}, 3, "}", 4]', '{"a": {"urls": [{"url": "x"}]}}', '{"\\u0075rls": [{"url": "x"}]}', '[NaN]', "[{'url': 1}]",
                '{"urls": [{"url": "x"}]', '{"x": "\\\\", "urls": [{"url": "x}"}]}')


@pytest.mark.parametrize("seed,range_bytes,few,size", [(1, 400, 10**6, 6), (2, 4000, 0, 20), (3, 1 << 20, 10**6, 30)])
def test_ranges_equal_whole_files(spark, scratch, seed, range_bytes, few, size, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(J, "PIECE_CHARS", rng.choice([0, 50, 100_000]))
    want = {}
    for i, t in enumerate(files(rng, size)):
        with open(os.path.join(scratch, f"{i}.json"), "w", encoding="utf-8", newline="") as f:
            f.write(t)
        entries, reason = whole(t)
        want[f"{i}.json"] = [(None, None, reason)] if reason else [(n, e, None) for n, e in enumerate(entries)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = J.elements(J.records(spark.read, scratch), few=few).selectExpr("file", "pos", "to_json(item) AS item", "reason").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {name: [] for name in want}
    for r in rows:
        got[os.path.basename(r.file)].append((r.pos, None if r.item is None else json.loads(r.item), r.reason))
    for name, expected in want.items():
        with open(os.path.join(scratch, name), encoding="utf-8", newline="") as f:
            text = f.read()
        assert sorted(got[name], key=lambda x: x[0] or 0) == expected, text[:400]


def test_compressed_file(spark, scratch):
    import gzip
    for name, t in (("a.json.gz", '[{"url": "a"}]'), ("b.json.gz", '{"urls": [{"url": "b"}]}')):
        with gzip.open(os.path.join(scratch, name), "wt") as f:
            f.write(t)
    assert sorted(r.url for r in seeds.read_seed_entries(spark, scratch).collect()) == ["a", "b"]


def test_invalid_bytes_and_frames_over_the_limit(spark, scratch, monkeypatch):
    with open(os.path.join(scratch, "a.json"), "wb") as f:
        f.write(b'[{"url": "\xff\xfe"}]')
    with open(os.path.join(scratch, "b.json"), "w") as f:
        json.dump({f"k{i}": {"a": 1} for i in range(200)}, f)
    monkeypatch.setattr(J, "FRAME_CHARS", 300)
    assert [(os.path.basename(r.file), r.reason) for r in seeds.seed_rejects(spark, scratch).collect()] == [("b.json", J.TOO_MUCH)]
    assert [r.url for r in seeds.read_seed_entries(spark, scratch, bad="skip").collect()] == ["��"]
