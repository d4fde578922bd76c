"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.shared import stored


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): for each end of an edge the least node that it can reach.

    `edges` has columns a and b of one orderable type; rows with a null end and
    loops are ignored, repeated rows do no harm, and no edges give no rows.
    Local contraction (Lacki et al., "Connected Components at Scale via Local
    Contractions"): each node goes to the one of least hash among itself and its
    neighbours, and edges then run between the nodes that were gone to. A star is one node
    after two rounds, and a chain loses a large share of its nodes in each. Minima are
    combined before the shuffle, so no node's neighbours meet in one task. Each round is
    written as a table: its size is known to the planner, and nothing that the planner
    derives from one round is carried into the next.
    """
    now = stored(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("a IS NOT NULL AND b IS NOT NULL AND u != v").distinct())
    gone: list[DataFrame] = []
    while not now.isEmpty():
        if len(gone) == rounds:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        drawn = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min(drawn("v")).alias("m")).select(F.col("u").alias("node"), F.least("m", drawn("u")).alias("m"))
        gone.append(low := stored(low.select("node", F.col("m.n").alias("to"))))
        one = now.join(low.select(F.col("node").alias("u"), F.col("to").alias("a")), "u").select("a", "v")
        two = one.join(low.select(F.col("node").alias("v"), F.col("to").alias("b")), "v").filter("a != b")
        now = stored(two.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if not gone:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = gone[0]
    for low in gone[1:]:
        out = out.join(low.select(F.col("node").alias("to"), F.col("to").alias("then")), "to", "left").select("node", F.coalesce("then", "to").alias("to"))
    least = out.groupBy("to").agg(F.min("node").alias("component"))
    return out.join(least, "to").select("node", "component")
