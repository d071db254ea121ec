"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' token weights
are raked to target shares of each margin in turn, round after round (ROUNDS at
least), until the table meets all three to a relative error of TOLERANCE.  Targets
that the cells cannot meet, told by an error that hardly falls, are reported by
a warning.  The raked weight of a cell over its share of the tokens
is how much the mixture wants of it; scaled, until no more cells reach one, so
that the expected sample holds the asked share of all tokens, with no probability
above one, that is the probability by which each of its documents is sampled.  The draw is the hash of
the id, so it can be repeated and does not depend on partitions.

Only SQL functions run: the cell table (small beside the documents) is written to
the shared folder each round, and documents are read twice, once for the cells
and once for the draw; their texts are not shuffled.

Defined results: null sources, languages and topics are the value "(null)"; a
null text has no tokens and topic "prose"; documents without tokens are drawn by
their cell like any other, and cells without any tokens are kept whole.  Rows
that share an id share the draw (a null id is one too).  A target value without
documents is left out and the others scaled up; a value without a target gets
none.  An empty table gives an empty result.  All columns of the input stay."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablerail.llm import common

MARGINS = ("source", "lang", "topic")
ROUNDS = 6
TOLERANCE = 1e-4
STALLED = 3  # rounds in which the error has to fall by a tenth
BROADCAST_CELLS = 50_000


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text holds: licence lines, figures, or prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.contains("License") | t.contains("Licensed") | t.contains("Copyright"), "legal")
            .when(t.rlike("[0-9]"), "figures").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def drawn(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the id, the same everywhere."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def _keyed(docs: DataFrame, topic: Column) -> list[Column]:
    null = F.lit("(null)")
    return [F.coalesce(F.col("source").cast("string"), null).alias("m_source"),
            F.coalesce(F.col("lang").cast("string"), null).alias("m_lang"),
            F.coalesce(topic.cast("string"), null).alias("m_topic")]


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Targets (value, target): each value's share of tokens to ``power``."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).withColumn("p", F.pow(F.col("t").cast("double"), F.lit(power)))
    return sums.select(F.col(margin), F.col("p").alias("target"))


def _raked(cells: DataFrame, margin: str, targets: DataFrame) -> DataFrame:
    """One step: the margin's sums of w become proportional to the targets."""
    now = cells.groupBy(margin).agg(F.sum("w").alias("s"))
    share = now.join(targets, margin, "left").withColumn("target", F.when(F.col("s") > 0, F.coalesce("target", F.lit(0.0))).otherwise(0.0))
    factor = share.select(margin, F.when(F.col("s") > 0, F.col("target") / F.col("s")).otherwise(0.0).alias("f"))
    return (common.salted_join(cells, factor, margin, ["m_source", "m_lang", "m_topic"], "inner", 4)
            .withColumn("w", F.col("w") * F.col("f")).drop("f"))


def margin_error(cells: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest relative error of any margin's share of ``w`` (targets add up to one)."""
    total = cells.agg(F.sum("w")).first()[0]
    if not total:
        return 0.0
    worst = 0.0
    for m, t in targets.items():
        now = cells.groupBy(m).agg((F.sum("w") / F.lit(float(total))).alias("s"))
        off = t.where("target > 0").join(now, m, "left").agg(F.max(F.abs(F.coalesce("s", F.lit(0.0)) / F.col("target") - 1)))
        worst = max(worst, float(off.first()[0] or 0.0))  # one number
    return worst


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with weight ``w`` fitted to the targets of every margin, in
    ``rounds`` or as many more as TOLERANCE takes.

    Each step is written before the next one reads it: the plans stay small and
    alike, where a chain of steps would double with every one."""
    # targets on one scale: shares of the values that have tokens
    scaled = {}
    for m, t in targets.items():
        there = cells.where("tokens > 0").select(m).distinct()
        have = t.join(there, m, "left_semi")
        total = have.agg(F.sum("target")).first()[0] or 1.0  # one number
        scaled[m] = common.keep(have.withColumn("target", F.col("target") / F.lit(float(total))), "mix-targets")
    now = common.keep(cells.withColumn("w", F.col("tokens").cast("double")), "mix-cells")
    errors: list[float] = []
    while not errors or errors[-1] > TOLERANCE:
        if len(errors) > STALLED and errors[-1] > 0.9 * errors[-1 - STALLED]:
            warnings.warn(f"mixing: the margins cannot all be met; largest relative error {errors[-1]:.2g}", stacklevel=2)
            break
        for _ in range(1 if errors else rounds):
            for m in targets:
                now = common.keep(_raked(now, m, scaled[m]), "mix-cells")
        errors.append(margin_error(now, scaled))
    return now


def probabilities(raked: DataFrame, share: float) -> DataFrame:
    """``raked`` with the sampling probability of each cell: proportional to
    w / tokens, at most one, and scaled (until no more cells reach one) so that
    the expected tokens are ``share`` of all."""
    sums = raked.agg(F.sum("w"), F.sum("tokens")).first()
    weight, tokens = float(sums[0] or 0.0), float(sums[1] or 0)
    if not weight:
        return raked.withColumn("probability", F.lit(1.0))
    ratio = F.col("w") / F.lit(weight) / (F.col("tokens") / F.lit(tokens))
    cells = raked.withColumn("ratio", F.when(F.col("tokens") > 0, ratio))
    scale, reached = share, -1
    while True:  # the tokens of cells that reach one only grow
        full = F.lit(scale) * F.col("ratio") >= 1
        row = cells.where("tokens > 0").agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("ratio") * F.col("tokens")))).first()
        now = int(row[0] or 0)
        if now <= reached:
            break
        if not row[1]:
            if now < share * tokens * (1 - TOLERANCE):
                warnings.warn(f"mixing: the cells with a target hold {now / tokens:.2g} of the tokens, {share:.2g} are asked", stacklevel=2)
            break
        scale, reached = (share * tokens - now) / float(row[1]), now
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(scale) * F.col("ratio")))
                            .otherwise(F.lit(1.0)))


def sample(docs: DataFrame, share: float = 0.7, power: float = 0.8, seed: str = "mix", topic: Column | None = None,
           targets: dict[str, DataFrame] | None = None, with_details: bool = False) -> DataFrame:
    """The sampled rows of ``docs``.

    ``targets``: (value, target) tables keyed m_source, m_lang, m_topic; by
    default each value's tempered share of tokens (``power`` below one lifts
    small sources and languages).  ``with_details`` adds m_* keys, tokens,
    probability."""
    topic = topic_of(F.col("text")) if topic is None else topic
    keys = [f"m_{m}" for m in MARGINS]
    cells = common.keep(docs.select(*_keyed(docs, topic), tokens_of(F.col("text")).alias("tokens"))
                        .groupBy(*keys).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "mix-table")
    targets = targets or {k: tempered(cells, k, power) for k in keys}
    table = common.keep(probabilities(rake(cells, targets), share), "mix-probabilities").select(*keys, "probability")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(row, *_keyed(docs, topic), drawn(F.col("doc_id"), seed).alias("__u"),
                       *([tokens_of(F.col("text")).alias("tokens")] if with_details else []))
    if table.count() <= BROADCAST_CELLS:  # a few MB; beyond it the join is dealt out
        hung = rows.join(F.broadcast(table), keys)
    else:
        cell = F.struct(*keys).alias("__cell")
        hung = common.salted_join(rows.withColumn("__cell", cell), table.select(cell, "probability"), "__cell", ["__u"], "inner")
    kept = hung.where(F.col("__u") < F.col("probability"))
    return kept.select("__row.*", *([*keys, "tokens", "probability"] if with_details else []))


# ------------------------------------------------------------------------ the SQL

def oracle_sql(share: float, power: float, seed: str) -> str:
    """DuckDB SQL of the sample (for the tests' and the driver's comparison), with as
    many rounds and scalings as the operator takes, by the same rules."""
    topic = ("CASE WHEN contains(coalesce(text, ''), 'License') OR contains(coalesce(text, ''), 'Copyright') THEN 'legal' "
             "WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures' ELSE 'prose' END")
    tokens = r"CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)"
    ctes = [f"d AS (SELECT doc_id, coalesce(source, '(null)') AS m_source, coalesce(lang, '(null)') AS m_lang, {topic} AS m_topic, "
            f"{tokens} AS tokens FROM documents)",
            "c AS (SELECT m_source, m_lang, m_topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL)"]
    keys = [f"m_{m}" for m in MARGINS]
    for k in keys:
        ctes += [f"p_{k} AS (SELECT {k}, pow(CAST(sum(tokens) AS DOUBLE), {power}) AS target FROM c GROUP BY {k} HAVING sum(tokens) > 0)",
                 f"t_{k} AS (SELECT {k}, target / sum(target) OVER () AS target FROM p_{k})"]
    cell = ", ".join([*keys, "tokens", *[f"t{i}" for i in range(len(keys))]])
    ctes.append(f"w0 AS (SELECT c.*, {', '.join(f't_{k}.target AS t{i}' for i, k in enumerate(keys))} FROM c "
                + " ".join(f"LEFT JOIN t_{k} ON c.{k} = t_{k}.{k}" for k in keys) + ")")
    # one round scales to each margin in turn; the errors from round ROUNDS on tell when to stop
    step = "(SELECT * FROM rounds WHERE n < {0} OR (errors[-1] > {1} AND NOT (len(errors) > {2} AND errors[-1] > 0.9 * errors[-1 - {2}])))".format(
        ROUNDS, TOLERANCE, STALLED)
    for i, k in enumerate(keys):
        step = (f"(SELECT n, errors, {cell}, CASE WHEN sum(w) OVER (PARTITION BY {k}) > 0 THEN w * coalesce(t{i}, 0) / "
                f"sum(w) OVER (PARTITION BY {k}) ELSE 0 END AS w FROM {step})")
    off = ", ".join(f"CASE WHEN sum(w) OVER () > 0 THEN abs(sum(w) OVER (PARTITION BY {k}) / sum(w) OVER () / t{i} - 1) END AS e{i}"
                    for i, k in enumerate(keys))
    worst = f"coalesce(max(greatest({', '.join(f'e{i}' for i in range(len(keys)))})) OVER (), 0)"
    ctes += [f"rounds AS (SELECT 0 AS n, CAST([] AS DOUBLE[]) AS errors, {cell}, CAST(tokens AS DOUBLE) AS w FROM w0 UNION ALL "
             f"SELECT n + 1, CASE WHEN n + 1 >= {ROUNDS} THEN list_append(errors, {worst}) ELSE errors END, {cell}, w "
             f"FROM (SELECT *, {off} FROM {step}))",
             "raked AS (SELECT * FROM rounds WHERE n = (SELECT max(n) FROM rounds))",
             "r AS (SELECT *, CASE WHEN tokens > 0 THEN (w / sum(w) OVER ()) / (tokens / CAST(sum(tokens) OVER () AS DOUBLE)) END AS ratio FROM raked)",
             # the scale, until no more cells reach one
             f"""scales AS (SELECT 0 AS i, CAST({share} AS DOUBLE) AS s, CAST(-1 AS DOUBLE) AS reached UNION ALL
  SELECT i + 1, ({share} * total - held) / rest, held FROM (SELECT i, s, reached, CAST(sum(tokens) AS DOUBLE) AS total,
    CAST(coalesce(sum(tokens) FILTER (s * ratio >= 1), 0) AS DOUBLE) AS held, sum(ratio * tokens) FILTER (s * ratio < 1) AS rest
    FROM r, scales GROUP BY i, s, reached) WHERE held > reached AND rest > 0)""",
             "scale AS (SELECT s FROM scales WHERE i = (SELECT max(i) FROM scales))"]
    u = f"CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0"
    return ("WITH RECURSIVE " + ",\n".join(ctes) + f"\nSELECT d.doc_id, d.m_source AS source, d.m_lang AS lang, d.m_topic AS topic, d.tokens, "
            f"round(CASE WHEN r.tokens > 0 THEN least(1.0, s * ratio) ELSE 1.0 END, 6) AS probability FROM d JOIN r "
            f"ON d.m_source = r.m_source AND d.m_lang = r.m_lang AND d.m_topic = r.m_topic, scale "
            f"WHERE {u} < CASE WHEN r.tokens > 0 THEN least(1.0, s * ratio) ELSE 1.0 END")
