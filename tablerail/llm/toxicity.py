"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, homoglyphs (letters of other scripts that
look Latin) and digits or signs that stand for letters become plain letters.
One Aho-Corasick automaton finds all lexicon entries in a folded text; entries
are word beginnings, so they match at the start of words only.  Exception
phrases (given ones, and words that begin like an entry but are no more frequent
in toxic texts) cancel the matches that they cover.  The weights of what is left
are summed and normalised by the number of words; a logistic curve turns sum,
density and length into a score.

The lexicon is learned from a bounded sample of labelled texts (at most
``PER_CLASS`` of each class): counting word beginnings and whole words is a
Spark aggregation over the sample.  An entry's weight is the log of how much more
often it occurs per word in toxic texts; entries need ``MIN_DOCS`` toxic texts
and a weight of ``MIN_WEIGHT``, and a greedy cover keeps those that explain toxic
texts which no stronger entry explains.

Defined results: null and empty texts have no match and score as such; rows
with a null doc_id are scored and never held out; without toxic labels the
lexicon is empty and every score is 0.  Repeated rows are scored each.  Whole
texts of any length are read.  Columns other than doc_id and text are ignored."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail.llm import common

PER_CLASS, MAX_CHARS = 6000, 100_000
MIN_DOCS, MIN_WEIGHT, MAX_ENTRIES = 4, 3.0, 3000
SUPPORT = 20  # toxic texts from which a term counts that others explain already
SHORTEST, LONGEST = 3, 8  # letters of a word beginning

# fixed values: letters and signs that look like plain letters
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "α": "a", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ſ": "s",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
# full-width forms are a fixed distance from ASCII; invisible signs inside words vanish
_FOLD = str.maketrans(HOMOGLYPHS | {chr(c + 0xFEE0): chr(c) for c in range(0x61, 0x7B)} | {"l": "i", "|": "i"}
                      | dict.fromkeys("­​‌‍﻿", ""))
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Folded text: letters that are easily confused (1, l, i) become one."""
    return (text or "").lower().translate(_FOLD)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(fold(text))


@dataclass
class Lexicon:
    """Entries (word beginnings) with weights, exception phrases, and the curve."""
    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = (0.0, 1.0, 1.0, 0.0)  # constant, then for FEATURES

    def automaton(self):
        """Aho-Corasick over " entry" and " exception " (blanks mark word ends)."""
        import ahocorasick
        auto = ahocorasick.Automaton()
        for e, w in self.entries.items():
            auto.add_word(f" {e}", (w, len(e) + 1))
        for x in self.exceptions:
            auto.add_word(f" {x} ", (None, len(x) + 2))
        if len(auto):
            auto.make_automaton()
        return auto

    def features(self, auto, text: str | None) -> tuple[float, int]:
        """(sum of weights, number of words); at each place the strongest entry
        counts once, and none inside an exception phrase."""
        words = words_of(text)
        if not len(auto) or not words:
            return 0.0, len(words)
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (w, n) in auto.iter(f" {' '.join(words)} "):
            start = end - n + 1
            if w is None:
                covered.append((start, end))
            else:
                best[start] = max(best.get(start, 0.0), w)
        for a, b in covered:
            for k in [k for k in best if a <= k < b]:
                del best[k]
        return sum(best.values()), len(words)


#: of a text with something found: weight, weight per hundred words, length
FEATURES = 3


def _x(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The length-normalised features."""
    return np.stack([np.log1p(total), np.log1p(100.0 * total / np.maximum(words, 1)), np.log1p(words) - 5.0], axis=-1)


def curve_score(curve: tuple[float, ...], total: np.ndarray, words: np.ndarray) -> np.ndarray:
    z = curve[0] + _x(np.asarray(total, dtype=float), np.asarray(words, dtype=float)) @ np.array(curve[1:])
    s = 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    return np.where(np.asarray(total) > 0, s, 0.0)  # nothing found: not toxic


# ---------------------------------------------------------------------- learning

def _beginnings(word: str) -> list[str]:
    """The word's beginnings, and itself with a closing blank."""
    return [word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [word + " "]


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, docs, toxic, clean): toxic documents with the term, and occurrences in
    toxic and clean ones, counted in each task first; texts that repeat count once."""
    once = sample.select("text", "label").distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, counts = Counter(), (Counter(), Counter())
        for f in frames:
            for text, label in zip(f["text"], f["label"], strict=True):
                here = Counter()
                for w, n in Counter(words_of(text)).items():
                    for b in _beginnings(w):
                        here[b] += n
                counts[label].update(here)
                if label:
                    docs.update(here.keys())
            if sum(map(len, counts)) > 1_000_000:  # bounded memory: pass on what there is
                yield _frame(docs, counts)
                docs, counts = Counter(), (Counter(), Counter())
        yield _frame(docs, counts)

    def _frame(docs: Counter, counts: tuple[Counter, Counter]) -> pd.DataFrame:
        terms = list(counts[0].keys() | counts[1].keys())
        return pd.DataFrame({"term": terms, "docs": [docs[t] for t in terms], "toxic": [counts[1][t] for t in terms],
                             "clean": [counts[0][t] for t in terms]})

    return (once.mapInPandas(run, "term string, docs long, toxic long, clean long").groupBy("term")
            .agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def learn(sample: DataFrame, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from (doc_id, text, label) rows, bounded by the caller."""
    sample = common.keep(sample, "toxicity-sample")
    none = Lexicon()
    lengths = measured(sample.select("text", "label").distinct(), none, ["label"]).groupBy("label").agg(F.sum("words").alias("n"))
    totals = {r["label"]: r["n"] for r in lengths.collect()}  # two rows
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1:
        return none
    terms = common.keep(term_counts(sample).where(F.col("docs") > 0), "toxicity-terms")
    weight = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    top = (terms.where(F.col("docs") >= MIN_DOCS).withColumn("w", weight).where(F.col("w") >= MIN_WEIGHT)
           .orderBy((F.col("w") * F.col("docs")).desc(), F.length("term"), "term").limit(MAX_ENTRIES).collect())
    # a whole word counts where it is longer than every beginning kept of it, or too
    # short to have one: then with its closing blank, so that it is no beginning
    weights = {r["term"] if len(r["term"]) <= SHORTEST else r["term"].rstrip(): float(r["w"]) for r in top
               if not r["term"].endswith(" ") or not SHORTEST + 1 <= len(r["term"]) <= LONGEST + 1}
    # which toxic texts hold which candidates: pairs of numbers, bounded by the sample
    names = list(weights)
    candidates = Lexicon({t: float(k + 1) for k, t in enumerate(names)})

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = candidates.automaton()
        for f in frames:
            rows = []
            for t in f["text"]:
                found = {int(w) - 1 for _, (w, _) in auto.iter(f" {' '.join(words_of(t))} ")} if len(auto) else set()
                rows.append(sorted(found))
            yield pd.DataFrame({"found": rows})

    docs = [set(r["found"]) for r in sample.where("label = 1").select("text").distinct().mapInPandas(held, "found array<int>").collect()]
    chosen = _cover(docs, names, weights)
    # words that begin like an entry but are as common in clean texts
    entries = {t: weights[t] for t in chosen}
    known = [F.col("term").startswith(t) for t in chosen]
    learned: list[str] = []
    if known:
        hit = known[0]
        for k in known[1:]:
            hit = hit | k
        whole = terms.where(F.col("term").endswith(" ") & hit & (F.col("clean") >= 2)).withColumn("w", weight).where("w <= 0.5")
        learned = [r["term"].strip() for r in whole.orderBy("w", "term").limit(MAX_ENTRIES).collect()]
    given = tuple(" ".join(words_of(x)) for x in exceptions)
    lexicon = Lexicon(entries, tuple(x for x in dict.fromkeys((*given, *learned)) if x))
    lexicon.curve = _fit_curve(sample, lexicon)
    return lexicon


def _cover(docs: list[set[int]], names: list[str], weights: dict[str, float]) -> list[str]:
    """Greedy: the entry that explains most toxic texts not yet explained, counted
    by weight; one that adds fewer than MIN_DOCS texts is chance or a copy's
    vocabulary.  Terms that stand beside chosen ones are kept by their own support."""
    open_, chosen = [d for d in docs if d], []
    often = Counter(t for d in docs for t in d)

    def longest(t: int) -> int:
        """The longest form that nearly as many texts hold: a beginning shorter than
        the words it stands for would also meet others."""
        forms = [k for k in often if names[k].startswith(names[t]) and often[k] >= 0.95 * often[t]]
        return max(forms, key=lambda k: (len(names[k]), often[k], names[k]))

    while open_:
        gain = Counter(t for d in open_ for t in d)
        # of beginnings that explain as much, the longest
        t = max(gain, key=lambda k: (round(gain[k] * weights[names[k]], 1), len(names[k]), names[k]))
        if gain[t] < MIN_DOCS:
            break
        t = longest(t)
        chosen.append(names[t])
        open_ = [d for d in open_ if t not in d]
    # entries in wide use that are no variant of a chosen one count too: they add
    # weight in texts that hold several
    have = set(chosen)
    for k, n in often.most_common():
        t = names[k]
        if n >= SUPPORT and weights[t] >= 1.5 * MIN_WEIGHT and not any(
                t.startswith(c) or c.startswith(t) for c in have):
            t = names[longest(k)]
            have.add(t)
            chosen.append(t)
    return chosen


def _fit_curve(sample: DataFrame, lexicon: Lexicon) -> tuple[float, ...]:
    """Logistic regression on the normalised features (sample rows only)."""
    rows = measured(sample, lexicon, ["label"]).where("total > 0").collect()  # two numbers and a label per sample row
    y = np.array([r["label"] for r in rows], dtype=float)
    if len(rows) < 10 or not (y == 0).any():
        return Lexicon().curve  # no clean text holds an entry: any find is a sign
    x = _x(np.array([r["total"] for r in rows]), np.array([r["words"] for r in rows], dtype=float))
    a = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    b = np.zeros(a.shape[1])
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        grad = a.T @ (p - y) + 0.1 * b
        hess = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(b))
        step = np.linalg.solve(hess, grad)
        b -= step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in b)


# ----------------------------------------------------------------------- scoring

def measured(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with total (weights found) and words of every text."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = lexicon.automaton()
        for f in frames:
            got = [lexicon.features(auto, t) for t in f["text"]]
            yield pd.DataFrame({**{c: f[c] for c in keep}, "total": [g[0] for g in got], "words": [g[1] for g in got]})
    types = dict(docs.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in keep] + ["total double", "words long"])
    return docs.select(*keep, "text").mapInPandas(run, schema)


def classify(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    c = [F.lit(v) for v in lexicon.curve]
    words = F.col("words").cast("double")
    z = (c[0] + c[1] * F.log1p("total") + c[2] * F.log1p(100.0 * F.col("total") / F.greatest(words, F.lit(1.0)))
         + c[3] * (F.log1p(words) - 5.0))
    score = F.when(F.col("total") > 0, 1.0 / (1.0 + F.exp(-z))).otherwise(0.0)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (measured(src, lexicon, ["doc_id"]).withColumn("score", score)
            .select("doc_id", F.coalesce(common.id_fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from the labelled rows outside the held-out fold."""
    return learn(common.labelled_sample(docs, labels, "toxic", folds, held, PER_CLASS, MAX_CHARS), exceptions)
