"""Connected components of a link table by alternating star operations.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).
Every round is a few joins and aggregations with map-side combining; rounds
are written to the shared folder, so lineage stays short. Nothing is collected
but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.tables import written


def _down(edges: DataFrame) -> DataFrame:
    """Edges as (u, v) with u > v, each once."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # an edge (u, v) with u > v is seen from v, to which u is the larger neighbour
    seen = edges.join(least.select(F.col("u").alias("v"), "m"), "v")
    return _down(seen.select("u", F.least("m", "v").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    among = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _down(among.unionByName(least.select("u", F.col("m").alias("v"))))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (u long, v long); the component is its smallest id."""
    now = written(_down(links), "links")
    digest = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = digest(now)
    while True:
        now = written(_small_star(_large_star(now)), "stars")
        after = digest(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
