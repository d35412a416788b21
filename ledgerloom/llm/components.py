"""Connected components of a link table, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import checkpoint


def connected_components(links: DataFrame) -> DataFrame:
    """Each linked node with the smallest node it can reach.

    ``links`` has two long columns, ``a`` and ``b``; direction and repeats do
    not matter, null ends are ignored.  Returns ``node, component`` for nodes
    that occur in a link.

    Every node points to a parent, at first to itself.  A round hangs a node,
    and its parent, below the smallest grandparent among its neighbours, and
    shortens paths to the grandparent.  Parents only get smaller, so their sum
    tells when nothing moves any more.  Hubs are met by partial aggregation
    (minimum) and by joins whose two sides come straight from an exchange,
    which adaptive execution can split.  Each round ends in a checkpoint.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = checkpoint(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = checkpoint(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("parent")).withColumnRenamed("a", "node"))
    total = None
    while True:
        now = state.agg(F.sum(F.col("parent").cast("decimal(38,0)")).alias("s")).first()["s"]
        if now == total:
            return state.select("node", F.col("parent").alias("component"))
        total = now
        up = state.select(F.col("node").alias("up"), F.col("parent").alias("grand"))
        paths = checkpoint(state.join(up, F.col("parent") == F.col("up")).select("node", "parent", "grand"))
        near = (
            both.join(paths.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy("a")
            .agg(F.min("grand").alias("least"))
        )
        near = paths.join(near, F.col("node") == F.col("a"))
        moves = (
            paths.select("node", F.col("grand").alias("parent"))
            .union(near.select("node", F.least("grand", "least").alias("parent")))
            .union(near.select(F.col("parent").alias("node"), F.col("least").alias("parent")))
        )
        state = checkpoint(moves.groupBy("node").agg(F.min("parent").alias("parent")))
