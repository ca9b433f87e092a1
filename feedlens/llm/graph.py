"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("bigint")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it reaches) of every node of ``edges`` (a, b: numbers, not null).

    The neighbours of a node never meet in one row or group: each step takes
    the smallest neighbour by a partial aggregate and joins it back, a join
    that adaptive execution splits at a hub. Every round is written to the
    shared folder, so lineage stays short and a lost executor costs one round.
    """
    star = common.written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(star)
    while state[0]:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = common.written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _state(star)
        if now == state:
            break
        state = now
    return star.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
