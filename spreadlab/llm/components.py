"""Connected components of an edge list by alternating star contractions.

Each step is a grouped minimum (combined on the map side) and a join; nothing is
gathered in one group and no edge or label reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them (edges have b < a)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (edges.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                    .alias("e")).select("e.a", "e.b").where("a <> b").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b): the least node of its component."""
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before = None
    for _ in range(max_rounds):
        seen = Observation()                       # read while the step is written: no job of its own
        cur = saved(_small_star(_large_star(cur)).observe(
            seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), narrow=True)
        now = (seen.get["n"], seen.get["h"])
        if now == before:
            return (cur.select(F.col("a").alias("node"), F.col("b").alias("label"))
                    .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
        before = now
    raise RuntimeError("components did not settle")
