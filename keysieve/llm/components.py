"""Connected components of a link table, by contraction.

In a round every node points to the least of its neighbours and itself, in an
order that changes from round to round, and every link is moved to the nodes
that its ends point to. Links inside a cluster vanish and the rest shrink by a
constant factor, so a few rounds do. Each round is written to the shared
folder: lineage stays short and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.operators.lineage import materialize


def _contract(links: DataFrame, parent: DataFrame) -> DataFrame:
    pa = parent.select(F.col("node").alias("a"), F.col("up").alias("pa"))
    pb = parent.select(F.col("node").alias("b"), F.col("up").alias("pb"))
    moved = links.join(pa, "a").join(pb, "b").where("pa <> pb")
    return moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``links(a, b)`` of longs -> ``(node, root)`` for every linked node."""
    links = materialize(links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = None
    for k in range(rounds):
        if roots is not None and links.isEmpty():
            return roots
        # Order of a round: the numbers with some bits turned over, another set each time.
        turn = F.xxhash64(F.lit(k))
        ends = links.select("a", "b").union(links.select("b", "a"))
        parent = materialize(ends.groupBy(F.col("a").alias("node")).agg(
            F.min(F.col("b").bitwiseXOR(turn)).alias("least")).select(
            "node", F.least("least", F.col("node").bitwiseXOR(turn)).bitwiseXOR(turn).alias("up")), "parents")
        if roots is None:
            roots = parent.select("node", F.col("up").alias("root"))
        else:
            up = parent.select(F.col("node").alias("root"), "up")
            roots = roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        links = materialize(_contract(links, parent), "links")
    raise RuntimeError(f"links are left after {rounds} rounds")
