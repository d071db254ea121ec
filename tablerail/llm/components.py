"""Connected components over link tables, with alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablerail.llm import common


def _stars(both: DataFrame, large: bool) -> DataFrame:
    """One star step over directed links (u, v).

    ``both`` holds each link in the directions the step needs; every node u
    sends its neighbours to the smallest of u and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("least")).select(
        "u", F.least("u", "least").alias("m"))
    hung = common.salted_join(both, least, "u", ["v"], "inner")
    if large:
        return hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    own = least.select("u", F.col("m").alias("v"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own).where("u <> v").distinct()


def min_label_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: longs); root is the
    smallest node of its component.

    Large-star and small-star rounds turn each component into one star; each
    step groups by node with a partial minimum and salted joins, so a node with
    many links is no bottleneck.  Rounds stop when a round changes nothing."""
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    path, last = None, None
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, True)
        small = _stars(large, False)
        new = common.shared_path(spark, "stars")
        small.write.parquet(new)
        if path:
            common.drop(spark, path)
        path, edges = new, spark.read.schema("u long, v long").parquet(new)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
