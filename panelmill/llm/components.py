"""Connected components of an edge table, by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round is a grouped minimum and a join,
both over (node, node) rows; nothing is collected, and each round is written, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.session import spent, written


def _star(edges: DataFrame, large: bool, name: str) -> DataFrame:
    """One star round. Edges are (u, v), a written table; every node is linked to the least node it sees.

    The least nodes are written before they are joined to the edges again: the join then deals both sides out anew, and the edges of a
    hub can be split over tasks."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    if large:
        both = edges.union(flipped)
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = written(least, f"{name}-least")
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    out = written(out.where("u <> v").distinct(), name)
    spent(least, edges)
    return out


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Rows (node, component): every node of an edge with the least node it reaches.

    ``edges`` has two long columns u and v; self loops and nulls are ignored; an empty table gives an empty table.
    """
    state = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    now = written(edges.where("u <> v").select("u", "v").distinct(), name)
    before = state(now)
    if before[0] == 0:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        now = _star(_star(now, True, name), False, name)
        after = state(now)
        if tuple(after) == tuple(before):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = after
    raise RuntimeError("components did not settle")
