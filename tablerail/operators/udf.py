"""User functions over table slices (UDF1, UDF2).

A rehydrator is a pandas function applied per URL.  A URL's rows are cut into
slices of at most ``chunk`` iterations so that one URL with a huge history never
lands whole in one Python worker; a function that needs the whole URL joins its
slices' objects in a tree, a bounded number at a time.

The slices of a task come sorted and stream through ``mapInPandas``, many to a
frame, so a small slice costs no Arrow batch of its own.  A plain function sees
one slice a call; one marked ``many_slices`` takes all slices of a frame at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("part", T.LongType()),
    T.StructField("n_rows", T.LongType()), T.StructField("stages", T.StringType()),
    T.StructField("last_iteration", T.IntegerType()),
])


def many_slices(fn: Callable) -> Callable:
    """Mark a function that takes a frame of many whole slices (or groups), one after
    the other, and returns one row for each, in their order."""
    fn.many_slices = True
    return fn


def _starts(pdf: pd.DataFrame, key: str) -> np.ndarray:
    """Where a slice begins: the rows whose URL or ``key`` differs from the row before."""
    new = np.arange(len(pdf)) == 0
    for c in ("url", key):
        v = pdf[c].to_numpy()
        none = pd.isna(v)
        new[1:] |= (v[1:] != v[:-1]) & ~(none[1:] & none[:-1])
    return np.flatnonzero(new)


def _in_order(pdf: pd.DataFrame, starts: np.ndarray, by: str) -> pd.DataFrame:
    """The rows of each slice ordered by a column."""
    sizes = np.diff(starts, append=len(pdf))
    return pdf.iloc[np.lexsort((pdf[by].to_numpy(), np.repeat(np.arange(len(starts)), sizes)))]


def _joined(texts: pd.Series, starts: np.ndarray) -> list[str]:
    texts, ends = texts.tolist(), [*starts[1:], len(texts)]
    return [",".join(texts[a:b]) for a, b in zip(starts, ends, strict=True)]


def _changes(after: np.ndarray, before: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """By slice: rows that differ from the row before them."""
    new = np.zeros(len(after), dtype="int64")
    new[1:] = after[1:] != before[:-1]
    new[starts] = 0
    return np.add.reduceat(new, starts)


@many_slices
def stage_history(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example rehydrator: one object per (url, part) slice – row count, stages in
    iteration order, last iteration."""
    starts = _starts(pdf, "part")
    pdf = _in_order(pdf, starts, "iteration")
    # fmax: an iteration that is missing is no largest one
    last = np.fmax.reduceat(pdf["iteration"].to_numpy(), starts)
    if pd.isna(last).any():
        raise ValueError("a slice without an iteration")
    return pd.DataFrame({
        "url": pdf["url"].to_numpy()[starts], "part": pdf["part"].to_numpy()[starts], "n_rows": np.diff(starts, append=len(pdf)),
        "stages": _joined(pdf["stage"].astype(str), starts), "last_iteration": last.astype("int32"),
    })


# Slice objects that one call of a combine function sees at most.
FAN_IN = 64


def _one(combine):
    """``combine`` with its rule: one object for the objects it is given."""
    many = getattr(combine, "many_slices", False)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        starts = _starts(pdf, "_to")
        out = combine(_in_order(pdf, starts, "part"))
        if len(out) != len(starts):
            raise ValueError(f"a combine function must return one row for its {len(pdf)}, not {len(out)}")
        return out.assign(part=pdf["_to"].to_numpy()[starts])
    run.many_slices = many
    return run


def _whole(frames: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames in which every slice is whole: the last slice of a batch waits for the
    next one, in which it may go on."""
    held: list[pd.DataFrame] = []
    for pdf in frames:
        if not len(pdf):
            continue
        cut = _starts(pdf, key)[-1]
        if held and (cut or len(_starts(pd.concat([held[-1].iloc[-1:], pdf.iloc[:1]]), key)) > 1):
            yield pd.concat([*held, pdf.iloc[:cut]], ignore_index=True)
            held = []
        elif cut:
            yield pdf.iloc[:cut]
        held.append(pdf.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _by_slice(df: DataFrame, key: str, fn, schema: T.StructType) -> DataFrame:
    """``fn`` over the groups of equal (url, ``key``)."""
    many = getattr(fn, "many_slices", False)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole(frames, key):
            if many:
                yield fn(pdf)[schema.names]
            else:
                starts = _starts(pdf, key)
                yield pd.concat([fn(pdf.iloc[a:b].reset_index(drop=True)) for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True)],
                                ignore_index=True)[schema.names]
    return df.repartition("url", key).sortWithinPartitions("url", key).mapInPandas(run, schema)


def rehydrate_by_url(df: DataFrame, fn=stage_history, schema: T.StructType = SLICE_SCHEMA, chunk: int = 1000,
                     combine=None, fan_in: int = FAN_IN) -> DataFrame:
    """UDF1: ``fn`` over each (url, iteration-range) slice; then, if given,
    ``combine`` over neighbouring slices' objects, round by round, until each URL
    has one.

    ``combine`` gets at most ``fan_in`` objects of one URL (the same columns, in
    order of ``part``) and must return one, which stands for them in the next
    round: it has to be associative, and its object should be no larger than what
    it replaces.  The number of rounds is the logarithm of the widest range of
    parts, so a URL with a third of all rows costs a round or two more, and no
    group passes ``fan_in`` objects or ``chunk`` iterations."""
    if chunk < 1 or fan_in < 2:
        raise ValueError("slices hold at least one iteration, and rounds join at least two slices")
    part = F.floor(F.col("iteration") / F.lit(chunk)).cast("bigint")
    if combine is None:
        return _by_slice(df.withColumn("part", part), "part", fn, schema)
    low, high = df.agg(F.min(part), F.max(part)).first()
    low, span = low or 0, (high or 0) - (low or 0) + 1
    # a row without an iteration comes first
    out = _by_slice(df.withColumn("part", F.coalesce(part - F.lit(low), F.lit(0))), "part", fn, schema)
    more = T.StructType(schema.fields)
    while span > 1:
        to = F.floor(F.col("part") / F.lit(fan_in)).cast("bigint")
        out = _by_slice(out.withColumn("_to", to), "_to", _one(combine), more)
        span = -(-span // fan_in)
    return out


@many_slices
def whole_history(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example combine step: one object per URL from its slices' objects."""
    starts = _starts(pdf, "_to")
    return pd.DataFrame({"url": pdf["url"].to_numpy()[starts], "part": 0, "n_rows": np.add.reduceat(pdf["n_rows"].to_numpy(), starts),
                         "stages": _joined(pdf["stages"], starts), "last_iteration": np.maximum.reduceat(pdf["last_iteration"].to_numpy(), starts)})


SUMMARY_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("part", T.LongType()), T.StructField("n_rows", T.LongType()),
    T.StructField("changes", T.LongType()), T.StructField("first_stage", T.StringType()), T.StructField("last_stage", T.StringType()),
])


@many_slices
def stage_summary(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rehydrator with an object of fixed size: rows, changes of stage, first and last stage."""
    starts = _starts(pdf, "part")
    pdf = _in_order(pdf, starts, "iteration")
    stages, sizes = pdf["stage"].astype(str).to_numpy(), np.diff(starts, append=len(pdf))
    return pd.DataFrame({"url": pdf["url"].to_numpy()[starts], "part": pdf["part"].to_numpy()[starts], "n_rows": sizes,
                         "changes": _changes(stages, stages, starts), "first_stage": stages[starts], "last_stage": stages[starts + sizes - 1]})


@many_slices
def joined_summary(pdf: pd.DataFrame) -> pd.DataFrame:
    """Combine step of ``stage_summary``: a change may lie between two objects."""
    starts = _starts(pdf, "_to")
    first, last = pdf["first_stage"].to_numpy(), pdf["last_stage"].to_numpy()
    n_rows, changes = (np.add.reduceat(pdf[c].to_numpy(), starts) for c in ("n_rows", "changes"))
    return pd.DataFrame({"url": pdf["url"].to_numpy()[starts], "part": 0, "n_rows": n_rows, "changes": changes + _changes(first, last, starts),
                         "first_stage": first[starts], "last_stage": last[np.append(starts[1:], len(pdf)) - 1]})
