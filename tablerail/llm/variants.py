"""Spelling variants: words one letter apart, found by PartEnum signatures.

A word's letters are a multiset, and that is a binary vector: one dimension for
the first e, one for the second e, and so on.  Words that differ by one replaced
letter have vectors at Hamming distance two, by one inserted or deleted letter at
distance one.  Partition and enumerate: the dimensions are dealt into ``n1``
groups; by the pigeonhole principle some group holds at most k2 = floor(k / n1)
of the k differences; each group is dealt into ``n2`` parts, and with every choice
of n2 - k2 of them goes one signature: the letters of those parts.  Two vectors
within k agree on at least one signature, so an equality join on signatures misses
nothing, and an exact check of the words themselves (edit distance one) decides.

Pairs of one length are joined with k = 2, pairs whose lengths differ by one with
k = 1 (fewer and longer signatures); the length is part of the key.  All letters
of one kind share a part, and parts are balanced by the letters' counts.

Crowded signatures (more than ``crowd`` words) are not joined pair by pair: there
the signature is extended by each word's forms with one letter blanked out (one
length) or deleted (two lengths), which near words share and which few others do.

Scale: the texts are read once; words are counted with map-side sums, so common
words are no hot keys.  What follows works on distinct words only.

Defined results: null texts have no words, a null id counts as the empty text; one
more row of a text counts again; an empty table gives no rows; other columns are
not read; texts of any length are read whole."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablerail.llm import common

# Letters of a run.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (k, n1, n2): differences, groups, parts a group
SAME, NEXT = (2, 1, 6), (1, 1, 4)
BALANCED_LETTERS = 200


# ---------------------------------------------------------------------- words

def occurrences(docs: DataFrame, least: int = 6, every: int = 199) -> DataFrame:
    """(word): one row for each run of at least ``least`` letters, A-Z lowered.

    Where the crc32 of ``<doc_id>:<run>`` is divisible by ``every``, one letter
    of the run is left out (the one at that number modulo the length)."""
    # a run of the text has at least `least` letters from its first one on, or none of its ends has
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    rows = (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
            .select("id", F.translate("run", UPPER, LOWER).alias("run")))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= least)


def count_words(found: DataFrame, least: int = 5) -> DataFrame:
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# ----------------------------------------------------------------- signatures

def balance(words: DataFrame, parts: int) -> dict[str, int]:
    """The part of each of the most frequent letters, so that parts weigh alike.

    Any dealing of letters is correct; the rest (beyond 200) go by hash."""
    rows = (words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").agg(F.count("*").alias("n"))
            .orderBy(F.col("n").desc(), "c").limit(BALANCED_LETTERS).collect())
    weight, out = [0] * parts, {}
    for r in rows:
        p = weight.index(min(weight))
        out[r.c] = p
        weight[p] += r.n
    return out


def choices(k: int, n1: int, n2: int) -> list[tuple[int, ...]]:
    """The enumerated sets of parts; parts are numbered over all groups."""
    if n2 <= k // n1:
        raise ValueError("a group needs more parts than differences")
    return [tuple(g * n2 + i for i in chosen) for g in range(n1) for chosen in combinations(range(n2), n2 - k // n1)]


def letters_by_part(word: str, parts: int, table: dict[str, int]) -> Column:
    """An array: the sorted letters of each part."""
    letters = F.array_sort(F.split(F.col(word), ""))
    own = lambda c: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    if table:
        known = F.create_map(*[F.lit(x) for item in table.items() for x in item])
        place = lambda c: F.coalesce(known[c], own(c))
    else:
        place = own
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)),
                       lambda p: F.array_join(F.filter(letters, lambda c: place(c) == p), ""))


def signatures(words: DataFrame, same: tuple[int, int, int] = SAME, following: tuple[int, int, int] = NEXT) -> DataFrame:
    """(key, role, word): every signature.  Role 0 joins words of one length; roles
    1 and 2 are the shorter and the longer word of a pair that differs in length."""
    rows = words.select("word")
    arrays = {}
    for name, (_, n1, n2) in (("same", same), ("next", following)):
        arrays[name] = letters_by_part("word", n1 * n2, balance(words, n1 * n2))
    rows = rows.select("word", F.length("word").alias("len"), *[a.alias(n) for n, a in arrays.items()])

    def key(name: str, length: Column, number: int, chosen: tuple[int, ...]) -> Column:
        return F.xxhash64(F.lit(name), length, F.lit(number), *[F.col(name)[p] for p in chosen])

    def row(k: Column, role: int) -> Column:
        return F.struct(k.alias("key"), F.lit(role).alias("role"))
    all_keys = [row(key("same", F.col("len"), i, c), 0) for i, c in enumerate(choices(*same))]
    for i, c in enumerate(choices(*following)):
        all_keys += [row(key("next", F.col("len") + 1, i, c), 1), row(key("next", F.col("len"), i, c), 2)]
    return rows.select("word", F.explode(F.array(*all_keys)).alias("s")).select("s.key", "s.role", "word")


def forms_of(word: str, role: str) -> Column:
    """Keys for words of a crowded signature: near words share one of them."""
    w, n = F.col(word), F.length(word)
    places = F.sequence(F.lit(1), n)
    rest = lambda i, by: F.concat(w.substr(F.lit(1), i - 1), F.lit(by), w.substr(i + 1, n))
    return (F.when(F.col(role) == 0, F.transform(places, lambda i: F.concat(i.cast("string"), F.lit(":"), rest(i, "\0"))))
            .when(F.col(role) == 1, F.array(w))
            .otherwise(F.array_distinct(F.transform(places, lambda i: rest(i, "")))))


def _verified(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    pairs = left.withColumnsRenamed({"word": "a", "role": "ra"}).join(right.withColumnsRenamed({"word": "b", "role": "rb"}), keys)
    fit = ((F.col("ra") == 0) & (F.col("rb") == 0) & (F.col("a") < F.col("b"))) | ((F.col("ra") == 1) & (F.col("rb") == 2))
    return pairs.where(fit).where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def near_words(words: DataFrame, same: tuple[int, int, int] = SAME, following: tuple[int, int, int] = NEXT, crowd: int = 64) -> DataFrame:
    """(a, b): every pair of ``words`` (word, unique) at edit distance one, once."""
    keys = common.keep(signatures(words, same, following), "variant-keys")
    size = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = common.keep(keys.join(size, "key"), "variant-shared")
    few = shared.where(F.col("n") <= crowd).drop("n")
    many = (shared.where(F.col("n") > crowd).drop("n")
            .select("key", "role", "word", F.explode(forms_of("word", "role")).alias("form")))
    return _verified(few, few, ["key"]).unionAll(_verified(many, many, ["key", "form"])).distinct()


# --------------------------------------------------------------------- groups

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each row of ``forms`` (word, form): the end of its chain.

    Each round doubles the steps taken; a form has several times its word's count,
    so chains end, after a number of steps that is the logarithm of a count."""
    spark = forms.sparkSession
    path, table = None, common.keep(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = table.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = table.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                     F.col("further").isNotNull().alias("went"))
        new = common.shared_path(spark, "variant-roots")
        step.write.parquet(new)
        if path:
            common.drop(spark, path)
        path, stepped = new, spark.read.schema(step.schema).parquet(new)
        table = stepped.select("word", "root")
        if stepped.where("went").isEmpty():
            return table


def group(words: DataFrame, times: int = 5, **signature_options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words`` (word, n).

    The form is the near word with the largest count (ties: the smallest word), if
    that count is at least ``times`` the word's own."""
    words = common.keep(words, "variant-words")
    pairs = common.keep(near_words(words, **signature_options), "variant-pairs")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = (both.join(other, "b").groupBy(F.col("a").alias("word"))
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("b").alias("form"))).alias("best")))
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("n"))).alias("f"))
    rows = common.keep(rows.select("word", F.col("f.form").alias("form"), "n", "n_near", F.col("f.n").alias("form_n")), "variant-forms")
    ends = roots(rows.where(F.col("form").isNotNull()).select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return group(count_words(occurrences(docs)))


def crc_step() -> list[int]:
    """The sixteen remainders of the checksum's polynomial, one for each half byte."""
    out = []
    for i in range(16):
        for _ in range(4):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


def oracle_sql() -> str:
    """DuckDB SQL: the checksum by half bytes; near words by blanked and deleted letters."""
    letter = "unicode(c)"
    return f"""
WITH RECURSIVE t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents),
d AS (SELECT id, run, count(*) AS times, id || ':' || run AS s FROM t WHERE length(run) >= 6 GROUP BY ALL),
y AS (SELECT *, flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN {letter} < 128 THEN [{letter} & 15, {letter} >> 4]
         ELSE [3, 12, ({letter} - 64) & 15, ({letter} - 64) >> 4] END)) AS halves FROM d),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(halves, lambda x: CAST(x AS BIGINT))),
         lambda r, x: xor(r >> 4, ({crc_step()}::BIGINT[])[CAST((xor(r, x) & 15) + 1 AS INT)])), 4294967295) AS h FROM y),
o AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
             ELSE run END AS word, times FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
l AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
b AS MATERIALIZED (SELECT word, i, left(word, i - 1) || ' ' || substr(word, i + 1) AS blank, left(word, i - 1) || substr(word, i + 1) AS less FROM l),
r AS (SELECT a.word, c.word AS near FROM b a JOIN b c ON a.i = c.i AND a.blank = c.blank AND a.word <> c.word
      UNION SELECT b.word, w.word FROM b JOIN w ON b.less = w.word
      UNION SELECT w.word, b.word FROM b JOIN w ON b.less = w.word),
g AS (SELECT r.word, count(*) AS n_near, max(w.n) AS top FROM r JOIN w ON r.near = w.word GROUP BY r.word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(g.n_near, 0) AS n_near, CASE WHEN g.top >= 5 * w.n THEN g.top END AS form_n,
      CASE WHEN g.top >= 5 * w.n THEN (SELECT min(r.near) FROM r JOIN w x ON r.near = x.word WHERE r.word = w.word AND x.n = g.top) END AS form
      FROM w LEFT JOIN g ON w.word = g.word),
chain AS (SELECT word, word AS at, form AS following FROM f
          UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN f ON chain.following = f.word)
SELECT f.word, f.form, chain.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM f JOIN chain ON f.word = chain.word AND chain.following IS NULL"""
