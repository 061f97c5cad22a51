"""Connected components by repeated contraction, all in DataFrames; the driver only learns whether anything is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import drop_staged, stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component: the smallest id that can be reached) of every id in edges (u, v); loops and nulls are ignored.

    Each round gives every node its smallest neighbour as parent, halves the parent chains until all end in a root,
    and contracts the edges onto the roots. Minima are combined before the shuffle, and a hub's rows meet in joins only,
    of staged tables, where adaptive execution splits them.
    """
    left = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    found: DataFrame | None = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = stage(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("u")).alias("root")), "parents")
        while True:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("above"))
            higher = stage(parent.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root"), (F.coalesce("above", "root") != F.col("root")).alias("moved")), "parents")
            drop_staged(parent)
            parent, moved = higher.select("id", "root"), not higher.where("moved").isEmpty()
            parent._staged_at = higher._staged_at
            if not moved:
                break
        side = lambda c: parent.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root"))
        nxt = left.join(side("u"), "u").join(side("v"), "v").where("u_root <> v_root")
        nxt = stage(nxt.select(F.greatest("u_root", "v_root").alias("u"), F.least("u_root", "v_root").alias("v")).distinct(), "edges")
        drop_staged(left)
        left = nxt
        if found is None:
            found = parent
        else:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("above"))
            merged = stage(found.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root")), "parents")
            drop_staged(found)
            drop_staged(parent)
            found = merged
    if found is None:
        found = left.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return found.select("id", F.col("root").alias("component"))
