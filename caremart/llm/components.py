"""Connected components of an edge table, by alternating star contractions.

Large-star hangs the larger neighbours of every node on its smallest
neighbour, small-star does the same with the smaller ones. After a few
rounds (the logarithm of the size, in practice) every node hangs on the
smallest node of its component. A round only groups and joins by node, so a
node with very many neighbours is an ordinary skewed key: its minimum is
pre-aggregated, and the join on it can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.sources.tables import staged


def _hang(sym: DataFrame, larger: bool) -> DataFrame:
    """Edges ``(a, b)`` of each node's neighbours to its smallest neighbour.

    The minima are written first: the join then has a plain shuffle on either
    side, which the adaptive planner can split where a node is hot.
    """
    least = sym.groupBy("a").agg(F.min("b").alias("m"))
    least = staged(least.select("a", F.least("a", "m").alias("m")), "cc-min")
    joined = sym.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.where("a <> m").select("a", F.col("m").alias("b"))
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row ``(id, component)`` per node that has an edge to another node.

    ``component`` is the smallest id that can be reached. Edges with a null
    end and loops count as no edge; direction and repetition do not matter.
    No edges give no rows. Every round is written to the shared folder, so a
    lost executor costs no earlier round.
    """
    now = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    now = now.where("a is not null and b is not null and a <> b")
    now = staged(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = staged(_hang(both, larger=True).distinct(), "cc-large")
        # Every edge of large points from a larger node to a smaller one.
        after = staged(_hang(large, larger=False).distinct(), "cc")
        inner = after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        # Done when every node hangs on one root and no root hangs on anything.
        once = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        if once and inner.isEmpty():
            return after.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                after.select("b", "b").toDF("id", "component").distinct()
            )
        now = after
