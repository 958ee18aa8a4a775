"""Connected components of a link table, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import materialise


def _least(edges: DataFrame) -> DataFrame:
    """For each node the least of itself and its neighbours: one partial minimum per task, so a hub is no hot task."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links of orderable ids -> (node, component), component the smallest id reachable.

    Alternates two steps until nothing changes: every larger neighbour of a node is led to the least of the node's
    neighbourhood, then every node and its smaller neighbours are led to the least of them. The number of rounds grows
    with the logarithm of the graph; each round's table goes to the shared folder. Links to itself and null ends are
    ignored; repeated links count once; nodes without a link are absent.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, mark = materialise(edges, "links"), None
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.join(_least(large), "a")
        small = small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                               F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = materialise(small.where("a <> b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
