"""Connected components of a large edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.session import land


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v longs); root is the smallest node that can be reached.

    Each round hooks every node to its smallest neighbour if that is smaller, shortens the pointers once, and rewrites the
    edges between what is left; local minima alone survive, so at least half of the nodes go in each round. Every round
    is landed in the shared folder. A node with very many edges is pre-aggregated before the shuffle. Loops and repeated
    edges change nothing; an edge with a null end is no edge; an empty table gives an empty table.
    """
    live = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u is not null and v is not null and u < v")
    live = land(live.distinct(), "edges")
    levels: list[DataFrame] = []
    while not live.isEmpty():
        both = live.union(live.select("v", "u"))
        hooked = land(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).select("node", F.least("node", "root").alias("root")), "hooks")
        above = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        level = land(hooked.join(above, "root").select("node", F.col("top").alias("root")), "roots")
        levels.append(level)
        u, v = (level.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "uv")
        ends = live.join(u, "u").join(v, "v").where("u_root <> v_root")
        live = land(ends.select(F.least("u_root", "v_root").alias("u"), F.greatest("u_root", "v_root").alias("v")).distinct(), "edges")
    if not levels:
        return live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = levels[0]
    for level in levels[1:]:
        step = level.select(F.col("node").alias("root"), F.col("root").alias("top"))
        found = found.join(step, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return land(found, "components")
