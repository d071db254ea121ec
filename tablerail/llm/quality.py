"""Quality classifier by supervised subword embeddings.

Features of a text are its words and the character 3- to 5-grams of its words
(with one blank at either side), hashed into ``BUCKETS`` vectors; a word equal
to the word before it also counts as the one feature "repeat".  A document is
the average of its features' vectors, a linear layer and a softmax give the
class.  Vectors and layer are learned together by stochastic gradient descent in
numpy (steps scaled per vector by its past gradients) on a bounded sample of
labelled documents: at most ``PER_CLASS`` texts of each class, up to
``MAX_CHARS`` characters each.

For scoring, vectors and layer collapse to one number per bucket, since the
logit of an average is the average of logits; so the model sent to the tasks is
one array of fixed size and whole texts are scored array-wise.

Defined results: a text without features (null, empty, blanks alone) scores by
the bias alone, that is about as common as label 1 is; rows with a null doc_id
are scored and never held out; without labels of both classes every score is 0.5.  Repeated
rows are scored each.  Columns other than doc_id and text are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail.llm import common

BITS = 18
BUCKETS = 1 << BITS
REPEAT = BUCKETS  # one feature beside the hashed ones
PER_CLASS, MAX_CHARS = 1500, 60_000
DIM, RATE = 8, 0.25
STEPS, EPOCHS = 9000, 20  # about so many steps, so many rounds at most
# a text counts as if it had so many features more, all of them neutral, so that
# a few words cannot decide as firmly as a page
NEUTRAL = 16
CHUNK = 1 << 19  # characters handled at once
# odd multipliers of the positions of an n-gram or word (from the golden ratio)
_POWERS = np.cumprod(np.full(64, 0x9E3779B1, dtype=np.uint32), dtype=np.uint32)
_MIX = np.uint32(0x85EBCA6B)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)) * _MIX
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)


def feature_arrays(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document number, feature) arrays of the texts, n-gram size by size."""
    codes = np.frombuffer((" " + "".join(f"{t} " for t in texts)).encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
    blank = (codes <= 32) | (codes == 0xA0) | (codes == 0x3000)
    codes[blank] = 32
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)  # of codes[1:]
    # n-grams: blanks only at their ends, so each lies in one word and its margins
    h = codes[:-1] * _POWERS[0] + codes[1:] * _POWERS[1]
    inner = ~blank[1:]
    for n in (3, 4, 5):
        if len(codes) < n:
            break
        m = len(codes) - n + 1
        h = h[:m] + codes[n - 1:] * _POWERS[n - 1]
        # codes[i + 1] to codes[i + n - 2] are not blank
        inside = inner[:m] if n == 3 else inside[:m] & ~blank[n - 2:n - 2 + m]  # noqa: F821
        at = np.flatnonzero(inside)
        yield owner[at], _bucket(h[at], n)
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(starts):
        return
    word = np.cumsum(~blank & np.concatenate(([True], blank[:-1])))
    offset = np.arange(len(codes)) - starts[np.maximum(word - 1, 0)]
    part = np.where(blank, 0, codes * _POWERS[offset & 63]).astype(np.uint32)
    words = np.add.reduceat(part, starts, dtype=np.uint32)
    who = owner[starts - 1]
    yield who, _bucket(words, 1)
    again = np.flatnonzero((words[1:] == words[:-1]) & (who[1:] == who[:-1])) + 1
    # as often as its word has letters, like the n-grams of any other word
    lengths = np.add.reduceat((~blank).astype(np.int64), starts)
    yield np.repeat(who[again], lengths[again]), np.full(int(lengths[again].sum()), REPEAT)


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(first number, texts) of runs of about CHUNK characters; long texts alone."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if k > first and size + len(t) > CHUNK:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


@dataclass
class Model:
    """``logit``: the contribution of each feature to label 1 over label 0."""
    logit: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        whole = [t or "" for t in texts]
        sums, counts = np.zeros(len(whole)), np.zeros(len(whole), dtype=np.int64)
        for first, part in chunks(whole):
            n = len(part)
            for who, features in feature_arrays(part):
                sums[first:first + n] += np.bincount(who, weights=self.logit[features], minlength=n)
                counts[first:first + n] += np.bincount(who, minlength=n)
        z = self.bias + sums / (counts + NEUTRAL)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def train(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    """Learn vectors, layer and bias from texts with labels 0 and 1."""
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS + 1, dtype=np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.5, 0.5, (BUCKETS + 1, DIM)).astype(np.float32) / DIM
    layer = rng.uniform(-1, 1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    past = np.full(BUCKETS + 1, 1e-8, dtype=np.float32)  # sums of squared gradients
    past_layer, past_bias = np.full_like(layer, 1e-4), np.full_like(bias, 1e-4)
    share = np.bincount(labels, minlength=2) / len(labels)
    weight = (0.5 / share).astype(np.float32)  # both classes count alike
    epochs = min(EPOCHS, max(1, round(STEPS / len(texts))))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for k in rng.permutation(len(texts)):
            found = [f for _, f in feature_arrays([texts[k]])]
            features, times = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.int64), return_counts=True)
            p = (times / (times.sum() + NEUTRAL)).astype(np.float32)
            hidden = p @ vectors[features]
            z = hidden @ layer + bias
            soft = np.exp(z - z.max())
            error = soft / soft.sum()
            error[labels[k]] -= 1.0
            error *= weight[labels[k]]
            back = layer @ error
            g = p[:, None] * back[None, :]
            past[features] += (g * g).mean(axis=1)
            vectors[features] -= rate * g / np.sqrt(past[features])[:, None]
            step = np.outer(hidden, error)
            past_layer += step * step
            layer -= rate * step / np.sqrt(past_layer)
            past_bias += error * error
            bias -= rate * 0.1 * error / np.sqrt(past_bias)
    logit = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(logit.astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held: int = 2,
        per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """A model from the labelled rows outside the held-out fold (bounded sample).

    Training runs in one task over at most 2 * ``per_class`` texts, in an order
    that depends on the texts alone; only the model comes to the driver."""
    sample = common.labelled_sample(docs, labels, label, folds, held, per_class, max_chars)
    one_task = sample.repartition(1).sortWithinPartitions(F.xxhash64("text"), "doc_id")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, marks = [], []
        for f in frames:
            texts += f["text"].to_list()
            marks += f["label"].to_list()
        m = train(texts, marks)
        yield pd.DataFrame({"logit": [m.logit.tobytes()], "bias": [m.bias], "classes": [len(set(marks))]})

    r = one_task.mapInPandas(learn, "logit binary, bias double, classes int").collect()
    if not r:
        return train([], [])
    model = Model(np.frombuffer(r[0]["logit"], dtype=np.float32), r[0]["bias"])
    if r[0]["classes"] == 2:
        # training weighs both classes alike; the score is for their true shares
        counts = (labels.where(common.id_fold("doc_id", folds) != held).groupBy(label).agg(F.count("*").alias("n"))
                  .where(F.col(label).isin(0, 1)).collect())  # two rows
        share = {r[0]: r[1] for r in counts}
        model.bias += float(np.log(share[1] / share[0]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score``; all columns stay (one of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.logit, model.bias))  # fixed size: 1 MB

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Model(*shared.value)
        for b in batches:
            yield pd.Series(m.scores([t if isinstance(t, str) else None for t in b]))

    return docs.withColumn("score", scored("text"))


def classify(docs: DataFrame, model: Model, threshold: float = 0.7, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(common.id_fold("doc_id", folds) == held, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return score(docs.select(row, "text"), model).where(F.col("score") >= threshold).select("__row.*")
