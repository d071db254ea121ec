"""SimHash near-duplicates against brute force."""
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF001
from tablerail.llm import simhash as S


def slow_fingerprint(text, words=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    parts, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            parts, word = (parts + [word], "") if word else (parts, "")
        else:
            word += c
    if not parts:
        return 0
    shingles = [" ".join(parts[i:i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(rows):
    """Brute force: (doc_id, fingerprint) -> component by all pairs."""
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b C", "a b c a b c a b c", "É x Y z w",
                                  "x " * 500 + "end", "日本 語 テスト です ね"])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_golay_words_within_two_bits_share_an_index():
    table, count = S.golay_errors()
    assert sorted(np.unique(count)) == [1, 6] and (count == 1).sum() == 277
    rng = random.Random(1)

    def indices(w):
        s = int(S._syndrome(np.array([w]))[0])
        return {(w ^ int(e)) >> 11 for e in table[s][:count[s]]}
    for _ in range(3000):
        w = rng.getrandbits(23)
        v = w ^ sum(1 << b for b in rng.sample(range(23), rng.randint(0, 2)))
        assert indices(w) & indices(v)


def test_fingerprints_within_two_bits_share_a_key():
    table, count = S.golay_errors()
    rng = random.Random(2)
    a = [rng.getrandbits(64) for _ in range(500)]
    b = [x ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 2))) for x in a]
    both = np.array(a + b, dtype=np.uint64).view(np.int64)
    rows, keys = S.keys_of(both, table, count)
    held = [set() for _ in both]
    for r, k in zip(rows.tolist(), keys.tolist(), strict=True):
        held[r].add(k)
    assert all(held[i] & held[i + len(a)] for i in range(len(a)))


def test_components_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    near = docs.limit(40).withColumn("doc_id", F.col("doc_id") + 100000).withColumn(
        "text", F.concat("text", F.lit(" tail")))
    docs = docs.unionByName(near)
    got = {r.doc_id: r for r in S.near_duplicates(docs).collect()}
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    assert len(got) == len(rows)
    for (doc, fp), c in zip(rows, classes(rows), strict=True):
        assert got[doc].fingerprint == f"{fp:016x}" and got[doc].component_id == c
    crowded = {r.doc_id: r.component_id for r in S.near_duplicates(docs, bucket=1).collect()}
    assert crowded == {k: r.component_id for k, r in got.items()}


@pytest.mark.parametrize("bucket", [4, 64])
def test_large_group_of_near_copies(spark, bucket):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(f if f < 1 << 63 else f - (1 << 64),) for _, f in rows]
    from tablerail.llm.components import min_label_components
    links = S.links(spark.createDataFrame(signed, "fp long"), bucket=bucket)
    comp = {r.node: r.root for r in min_label_components(links).collect()}
    want = classes(rows)
    mine = [comp.get(s[0], s[0]) for s in signed]
    pairs = {}
    for m, w in zip(mine, want, strict=True):
        assert pairs.setdefault(m, w) == w
    assert len(set(pairs.values())) == len(pairs)


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, fp string, component_id long, key int"
    rows = [(1, None, "a", "x", 9, 1), (2, "", "b", "y", 9, 2), (3, "  ", None, None, None, 3), (4, "a b c d", "a", "z", 1, 4),
            (4, "a b c d", "a", "z", 1, 4), (5, "A B C D", None, "w", 2, 5), (None, "a b c d", "a", "q", 3, 6),
            (None, "quite another text here", "a", "q", 3, 7)]
    out = S.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.component_id) for r in out} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, 4), (None, None)}
    kept = S.keep_first(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "lang", "fp", "component_id", "key"]
    assert sorted((r.doc_id or 0, r.key) for r in kept.collect()) == [(0, 6), (0, 7), (1, 1), (4, 4)]
    none = spark.createDataFrame([], schema)
    assert S.near_duplicates(none).count() == 0 and S.keep_first(none).count() == 0


def test_very_long_text():
    text = "word%d " * 3 % (1, 2, 3) * 40000
    assert S.fingerprint(text) == slow_fingerprint(text)
