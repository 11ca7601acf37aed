"""Connected components of a link table by large-star and small-star steps, all as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmeter.llm.common import Cuts, join_spread

LINKS = 1 << 18  # links in one partition, where a step begins


def components(links: DataFrame, a: str, b: str, cuts: Cuts) -> DataFrame:
    """One row (node, component) per node of the links; the component is its smallest node.

    Every step replaces a link by one to the smallest neighbour of its end. A node may have any number
    of links: its neighbours meet in a minimum, taken in part before the shuffle, never in a list, and are
    told the result in a join that deals out nodes of many links. Steps go on until the links stop
    changing, a number that grows with the logarithm of the nodes. Each begins with as many partitions as
    its links need; its table goes when the next one is there. The result is one of the cuts.
    """
    edges = cuts.keep(_downward(links.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
        parts = 1 + state[0] // LINKS
        starred = cuts.keep(_large_star(edges.coalesce(parts)))
        cuts.drop(edges)
        edges = cuts.keep(_small_star(starred.coalesce(2 * parts)))
        cuts.drop(starred)
    roots = edges.select(F.col("v").alias("node")).distinct()
    found = cuts.keep(
        edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
            roots.withColumn("component", F.col("node"))
        )
    )
    cuts.drop(edges)
    return found


def _downward(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to its smallest neighbour (or itself)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    # For v's larger neighbour u, v's least neighbour is below v, or v itself if it has none.
    below = join_spread(edges, least.select(F.col("u").alias("v"), "m"), "v", "left")
    return _downward(
        below.select("u", F.coalesce("m", "v").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_spread(edges, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _downward(moved.unionByName(least.select("u", F.col("m").alias("v"))))
