"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a minimum per node (partial aggregation, so a hub costs one row per map
task) and a join back on the node (AQE splits a hub's partition). Each round is
checkpointed, so a lost executor recomputes one round at most, and nothing but two
numbers of the fixed-point test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.session import ensure_checkpoint_dir


def _with_min(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the smallest of u and its neighbours."""
    low = edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return edges.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_min(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    linked = _with_min(edges)
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
    return linked.select(F.explode(pairs).alias("p")).select("p.*").filter("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link.

    ``links`` holds pairs of longs in any order; repeats, self-links and rows with a null
    end are ignored. Nodes without a link are not listed. An empty table gives none.
    """
    ensure_checkpoint_dir(links.sparkSession)
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = (links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
                  .distinct().checkpoint())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        edges = _small_star(_large_star(edges)).checkpoint()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
