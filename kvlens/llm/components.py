"""Connected components by alternating star contractions.

Every step is an aggregation that combines before its shuffle or an equi-join of
two written tables, so a node with very many links is split by adaptive
skew-join handling; no neighbour list is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Links (u, v) of any one orderable type to rows (node, root): root is the least node that node reaches.

    Null ends and self links are left out; repeated links count once. Nodes without links have no row.
    Ends when a round changes nothing; ``max_rounds`` only guards against a fault (it raises).
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "links")
    before = _signature(e)
    for _ in range(max_rounds):
        # Large star: links to larger neighbours move to the least of the neighbourhood.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("x"), F.least("u", "w").alias("m")), "least")
        large = both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        mid = written(large.where("u <> v").distinct(), "links")
        # Small star: smaller neighbours and the node itself move to the least.
        small = written(mid.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x"), "least")
        moved = mid.join(small, F.col("u") == F.col("x")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(moved.union(small.select(F.col("x").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        discard(e, least, mid, small)
        e, now = after, _signature(after)
        if now == before:
            leaf = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            root = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return leaf.union(root)
        before = now
    raise RuntimeError(f"components: not settled after {max_rounds} rounds")
