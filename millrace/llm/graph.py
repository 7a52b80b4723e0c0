"""Connected components by contraction, in Spark joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of `edges` (columns u and v); root is the same within a component.

    Each round draws a priority for every node, by a hash of it and the round, and maps the node to that of itself and its
    neighbours whose priority is least; edges are joined to their ends' images, and those within one image vanish. As the
    priorities are new in each round, a constant share of the nodes vanishes in expectation, however the nodes are numbered,
    so the rounds are logarithmic in the largest component. The rounds' maps, ever smaller, are composed from the last one on.
    No edges, or only loops, give no rows (loops' nodes are left out).
    """
    maps = []
    ends = [F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]
    edges = scratch.save(edges.where("u <> v").select(*ends).distinct())
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while not edges.isEmpty():
        drawn = _drawn(len(maps))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy(F.col("u").alias("node")).agg(F.min(drawn("v")).alias("m"))
        images = scratch.save(near.select("node", F.least(F.col("m"), drawn("node"))["v"].alias("root")))
        maps.append(images)
        a = images.select(F.col("node").alias("u"), F.col("root").alias("a"))
        b = images.select(F.col("node").alias("v"), F.col("root").alias("b"))
        moved = edges.join(a, "u").join(b, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        before, edges = edges, scratch.save(moved.distinct())
        scratch.drop(before)
    scratch.drop(edges)
    out = maps.pop()
    while maps:
        after = out.select(F.col("node").alias("root"), F.col("root").alias("next"))
        images, before = maps.pop(), out
        out = scratch.save(images.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        scratch.drop(images)
        scratch.drop(before)
    return out


def _drawn(turn: int):
    def column(name: str) -> Column:
        return F.struct(F.xxhash64(F.lit(str(turn)), F.col(name)).alias("p"), F.col(name).alias("v"))  # text, so that all rounds share their compiled code

    return column
