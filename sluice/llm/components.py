"""Connected components of a graph of long ids, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import materialize


def attach(rows: DataFrame, groups: DataFrame, key: str, spread_by: str, ways: int = 16) -> DataFrame:
    """``rows`` joined with one value a group; a hot key's rows go to ``ways`` tasks, chosen by ``spread_by``."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(ways)).cast("int"))
    copied = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return salted.join(copied.hint("merge"), [key, "_salt"]).drop("_salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return attach(both, least, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = attach(edges, least, "u", "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) of every node of the edges (u, v): the label is the component's smallest node.

    Each round lets every node point to the smallest node it knows of; after a number of rounds that grows with the
    logarithm of the graph every component is a star. Rounds are written to the shared scratch folder, so a lost
    executor costs one round at most. Self-loops and repeated edges are allowed.
    """
    now = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = materialize(now, "components")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == before or not state["n"]:
            break
        before = tuple(state)
        now = materialize(_small_star(_large_star(now).where("u <> v").distinct()), "components")
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
