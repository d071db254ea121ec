"""Spelling variants against plain loops."""
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablerail.llm import variants as V


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(docs, least=5):
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= least}


def plain_groups(words):
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def mutate(rng, w, letters):
    i = rng.randrange(len(w))
    return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:],
                       w[:i] + w[i + 1:] + w[i]])


def vocabulary(rng, size, letters, length):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(size // 3)}
    while len(words) < size:
        words.add(mutate(rng, rng.choice(sorted(words)[:200]), letters))
    return {w: rng.choice([5, 6, 25, 30, 150, 900]) for w in words if len(w) >= 3}


@pytest.mark.parametrize("seed,letters,options", [
    (0, "abcdefghijklmnopqrstuvwxyzéß÷", {}),
    (1, "abc", {}),
    (2, "ab", {"crowd": 2}),
    (3, "abcdeé", {"crowd": 0}),
    (4, "abcdefgh", {"same": (2, 2, 3), "following": (1, 1, 3)}),
    (5, "abcdefgh", {"same": (2, 3, 1), "following": (1, 2, 2), "crowd": 5}),
])
def test_groups_equal_plain_loops(spark, seed, letters, options):
    words = vocabulary(random.Random(seed), 500, letters, (6, 9))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(V.group(df, **options)) == plain_groups(words)


def test_signatures_hold_the_pigeonhole():
    assert len(V.choices(2, 1, 6)) == 15 and len(V.choices(2, 2, 3)) == 6 and len(V.choices(2, 3, 1)) == 3
    with pytest.raises(ValueError):
        V.choices(2, 1, 2)


def test_documents(spark):
    rng = random.Random(7)
    stems = ["wonderful", "Señorita", "Überlegung", "kitchens", "kitchen", "ÉCOLES", "short", "façades"]
    docs = []
    for i in range(400):
        words = [rng.choice(stems) for _ in range(60)]
        docs.append((i, " ".join(mutate(rng, w, "aeé") if rng.random() < 0.02 else w for w in words)))
    docs += [(None, "kitchens " * 7), (9, None), (10, ""), (11, "a1b2c3 ×÷×÷×÷ " * 6), (12, "kitchenz " * 30_000), (12, "kitchenz " * 30_000), (13, "x" * 100_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("word"), F.lit(2).alias("n"), F.lit("r").alias("run"))
    words = plain_words(docs)
    assert "señorita" in words and "École".lower() not in words and len(words) > 8
    assert rows(V.variants(df)) == plain_groups(words)


def test_one_letter_is_left_out(spark):
    docs = [(i, "variation") for i in range(4000)]
    got = {r.word: r.n for r in V.count_words(V.occurrences(spark.createDataFrame(docs, "doc_id long, text string")), 1).collect()}
    assert got == plain_words(docs, 1) and len(got) > 3


def test_chains_end_at_the_root(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625}
    got = {r.word: r.root for r in V.group(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"abbbbb"}


def test_empty_table(spark):
    assert V.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
