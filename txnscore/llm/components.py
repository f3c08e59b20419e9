"""Connected components of distributed edges, each step a written table.

Alternates two joins by grouped minimum (every larger neighbour is linked to
the least one, then every node to its least neighbour) until nothing changes.
Minima are pre-aggregated before their shuffle, so a node with very many
neighbours costs one row per task; the join back has plain scans on both sides,
so Spark may split such a node. Only two counters reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.common import written


#: Edges per file of a written step, so that small graphs are not read by very many tasks.
EDGES_PER_FILE = 100_000


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _star(edges: DataFrame, large: bool, files: int) -> DataFrame:
    """One star step over edges (a > b); returns edges (a > b) again, distinct."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    pairs = edges.unionByName(back) if large else edges
    least = written(pairs.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "cc-least")
    joined = pairs.join(least, "a")
    if large:  # link every larger neighbour to the least of the neighbourhood
        out = joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:  # link every smaller neighbour, and the node, to the least one
        out = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return written(out.where("a != b").distinct().coalesce(files), "cc-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is
    the smallest node reachable. Nodes are any orderable type."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = written(edges.where("a != b").select(high.alias("a"), low.alias("b")).distinct(), "cc-edges")
    state = _checksum(now)
    while state[0]:
        files = state[0] // EDGES_PER_FILE + 1  # the number of edges never grows
        now = _star(_star(now, True, files), False, files)
        after = _checksum(now)
        if after == state:
            break
        state = after
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).distinct()
    return nodes.unionByName(roots.select("node", F.col("node").alias("component")))
