"""Connected components of links, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkweft.llm.frames import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node with a link; label is the least node of its component.

    `links` has columns a and b.  Large-star and small-star steps take turns until the
    edges are stars; the number of turns grows with the logarithm of the longest path.
    Every step is an aggregation and a join, with its result written to the shared folder.
    """
    start = links.where("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
    edges, state = _written(start)
    while True:
        both = edges.unionByName(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
        least = written(both.groupBy(F.col("child").alias("u")).agg(F.min("parent").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        # every larger neighbour of a node is hung under the least of its neighbours
        large = written(
            both.join(least, F.col("child") == F.col("u")).where("parent > u").select(F.col("parent").alias("child"), F.col("m").alias("parent")),
            "large-star",
        )
        # every smaller neighbour, and the node itself, likewise
        root = written(large.groupBy(F.col("child").alias("u")).agg(F.min("parent").alias("m")), "root")
        moved = large.join(root, F.col("child") == F.col("u")).where("parent <> m").select(F.col("parent").alias("child"), F.col("m").alias("parent"))
        before = state
        edges, state = _written(root.select(F.col("u").alias("child"), F.col("m").alias("parent")).unionByName(moved))
        if state == before:
            break
    ends = edges.select(F.col("child").alias("node"), F.col("parent").alias("label")).unionByName(edges.select(F.col("parent").alias("node"), F.col("parent").alias("label")))
    return ends.distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct edges, written; and what tells two sets of them apart: number and sum of hashes."""
    seen = Observation()
    counted = edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)")).alias("h"))
    out = written(counted, "edges")
    return out, (seen.get["n"], seen.get["h"])
