"""Secret scans: spans against a plain scan, and what the ledger spares."""
import hashlib
import os
import random
import string

import pytest
from pyspark.sql import functions as F

from tablerail.llm import common, ledger

HEX = "0123456789abcdef"


def plain_spans(t):
    """The base kinds by hand: no pattern library."""
    out, i = [], 0
    words = ("password", "passwd", "secret", "token", "api_key", "apikey")
    value = set(string.ascii_letters + string.digits + "+/_.=-")
    while i < len(t):
        word = next((w for w in words if "".join(c.lower() if c in string.ascii_uppercase else c for c in t[i:i + len(w)]) == w), None)
        if word:
            j = i + len(word)
            j += t[j:j + 1] in ("'", '"') and t[j:j + 1] != ""
            while t[j:j + 1] == " ":
                j += 1
            if t[j:j + 1] in (":", "=") and t[j:j + 1]:
                j += 1
                while t[j:j + 1] == " ":
                    j += 1
                j += t[j:j + 1] in ("'", '"') and t[j:j + 1] != ""
                k = j
                while k < len(t) and t[k] in value:
                    k += 1
                if k > j:
                    if k - j >= 8:
                        out.append((i, 0, k, "assign"))
                    i = k
                    continue
        i += 1
    for at, kind, lead, allowed, least in ((1, "access", "AKIA", set(string.ascii_uppercase + string.digits), 16), (2, "hex", "", set(HEX), 32)):
        i = 0
        while i < len(t):
            k = i + len(lead)
            if t.startswith(lead, i):
                while k < len(t) and t[k] in allowed:
                    k += 1
                if k > i + len(lead):
                    if k - i >= least:
                        out.append((i, at, k, kind))
                    i = k
                    continue
            i += 1
    return sorted(out)


def noise(rng):
    bits = ["token", "Token", "SECRET", "passwd", "password", "api_key", "apiKey", "AKIA", "AKIAAKIA", "=", ":", " ", "  ", '"', "'", "é", "ſecret",
            "toKen", "abcdefgh", "0123456789abcdef" * 2, "deadbeef", "A1B2C3D4E5F6", "\n", "secret=token", "x", "Z9"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))


def test_spans_equal_a_plain_scan():
    rng = random.Random(3)
    for _ in range(4000):
        t = noise(rng)
        got = [(s, a, e, r.split("@")[0]) for s, a, e, r in ledger.spans(t, ledger.BASE)]
        assert got == plain_spans(t), t


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def result(df):
    return {r.doc_id: r for r in ledger.digests(df).collect()}


def test_added_spans_and_digest(spark):
    t = ("-----BEGIN RSA PRIVATE KEY----- postgres://me:hunter22@db/x Bearer abcdefghijklmnopqrstuvwxyz "
         "ghp_" + "xY1" * 14 + " token = 'abcdefgh1'")
    got = result(ledger.scan(table(spark, [(1, t)]), common.shared_path(spark, "l")))[1]
    kinds = [s.split(":")[0] for s in got.spans.split(",")]
    assert kinds == ["pem", "login", "bearer", "forge", "assign"]
    base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in plain_spans(t))
    assert got.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert (got.n_assign, got.n_access, got.n_hex) == (1, 0, 0)


def test_only_unseen_pairs_are_scanned(spark):
    path = common.shared_path(spark, "l")
    one = [(i, f"token = value{i % 3}0000000") for i in range(30)]
    v = table(spark, one)
    a = common.keep(ledger.address(v), "a")
    assert ledger.update(v, a, path) == 3  # copies are one blob
    assert ledger.update(v, a, path) == 0
    more = table(spark, one + [(90, "token = fresh000000"), (91, "token = value00000000")])
    b = common.keep(ledger.address(more), "a")
    assert ledger.update(more, b, path) == 1
    # a new version of one rule runs alone, over every blob
    rules = (ledger.Rule("assign", 2, r"(token) = (\w+)", 2, 1), *ledger.RULES[1:])
    assert ledger.update(more, b, path, rules) == 4
    last = max(ledger._runs(spark, path), key=lambda p: os.path.getmtime(p.removeprefix("file:")))
    assert {tuple(r.rules) for r in spark.read.parquet(last).collect()} == {("assign@2",)}
    seen = ledger.read_ledger(spark, path)
    assert {r.doc_id: r.spans for r in ledger.digests(ledger.findings(b, seen, rules), rules).collect()}[90] == "assign:0:19"
    before = {r.doc_id: r.spans for r in ledger.digests(ledger.findings(b, seen)).collect()}
    assert len(before) == 32 and before[91] == before[0] == "assign:0:21"
    ledger.compact(spark, path)
    assert len(ledger._runs(spark, path)) == 1
    assert {r.doc_id: r.spans for r in ledger.digests(ledger.findings(b, ledger.read_ledger(spark, path))).collect()} == before
    assert ledger.update(more, b, path) == 0


def test_a_run_that_died_does_not_count(spark):
    path = common.shared_path(spark, "l")
    v = table(spark, [(1, "token = abcdefgh")])
    a = common.keep(ledger.address(v), "a")
    ledger.update(v, a, path)
    os.remove(os.path.join(ledger._runs(spark, path)[0].removeprefix("file:"), "_SUCCESS"))
    assert ledger._runs(spark, path) == []
    assert ledger.update(v, a, path) == 1
    assert [len(r.found) for r in ledger.findings(a, ledger.read_ledger(spark, path)).collect()] == [1]


@pytest.mark.parametrize("few", [0, 1000])
def test_edge_rows(spark, few):
    long = "x " * 200_000 + "AKIA" + "Z" * 20
    rows = [(1, None), (2, ""), (3, long), (None, "token: abcdefgh"), (3, long), (5, "AKIA" + "0" * 12)] + [(6, "token=same56789")] * 40
    v = table(spark, rows).select("*", F.lit(1).alias("digest"), F.lit(2).alias("row"), F.lit(3).alias("found"))
    path = common.shared_path(spark, "l")
    a = common.keep(ledger.address(v), "a")
    assert ledger.update(v, a, path, few=few) == 5
    got = ledger.findings(a, ledger.read_ledger(spark, path))
    assert got.select("row.digest", "row.row", "row.found").distinct().collect() == [(1, 2, 3)]
    out = sorted((str(r.doc_id), r.spans) for r in ledger.digests(got).collect())
    assert out == sorted([("1", ""), ("2", ""), ("3", "access:400000:400024"), ("3", "access:400000:400024"), ("None", "assign:0:15"),
                          ("5", "access:0:16")] + [("6", "assign:0:15")] * 40)


def test_empty_table(spark):
    assert ledger.digests(ledger.scan(table(spark, []), common.shared_path(spark, "l"))).collect() == []


def test_hot_keys_are_joined_apart(spark):
    rows = common.keep(spark.range(5000).select(F.when(F.col("id") < 3000, "hot").when(F.col("id") == 4000, None)
                                                .otherwise(F.col("id").cast("string")).alias("k"), "id"), "r")
    per = spark.createDataFrame([("hot", 1), ("3500", 2)], "k string, v int")
    got = common.join_back(rows, per, "k").collect()
    assert len(got) == 5000 and sum(r.v == 1 for r in got) == 3000 and sum(r.v == 2 for r in got) == 1
