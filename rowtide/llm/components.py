"""Connected components of a link table, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import settle

#: Links a partition, about: a task that writes a shuffle writes three files at least, however few links it has.
PART = 100_000


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label): the least label of each node's component.

    ``links`` has a, b in any direction, repeats allowed; ``nodes`` has every node once with
    its own label. Nodes are ordered by value: links are turned into stars around the least
    node by alternating rounds (large star, small star), the number of which grows with the
    logarithm of the longest path. A node's links are never gathered in one place: each
    round is a minimum per node, combined on the map side, and a join back. The links are
    counted in each round and held in as many partitions as that takes.
    """
    edges = settle(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before, n = None, edges.count()
    while True:
        parts = max(1, -(-n // PART))
        edges = edges.coalesce(parts)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every greater neighbour of a node is linked to the least around it.
        large = (
            both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
        )
        # Small star: so are the smaller neighbours, and the node itself.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = settle(
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter(F.col("u") != F.col("v"))
            .coalesce(parts)
            .distinct()
            .coalesce(parts)
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            break
        before, n = now, now[0]
    root = nodes.select("node", "label").join(edges.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    rooted = root.select("node", "label", F.coalesce("root", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min("label").alias("best"))
    return rooted.join(best, "root").select("node", F.col("best").alias("label"))
