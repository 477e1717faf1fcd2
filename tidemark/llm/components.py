"""Connected components of an edge table, by alternating large and small stars.

Each round hooks every neighbour onto the smallest one known, written to the shared folder; about log n
rounds are enough. Groupings combine before they shuffle, and joins on a hub are split by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    hooked = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return hooked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge points from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    found = edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.pmod(hashed, F.lit(1 << 31)))).first()
    return tuple(found)


def connected(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component), for nodes that have an edge u, v."""
    current = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    mark = _mark(current)
    while True:
        current = stored(_small_star(_large_star(current)), "edges")
        before, mark = mark, _mark(current)
        if before == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
