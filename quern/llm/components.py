"""Distributed union-find: connected components of a table of links, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import release, written


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of the links (a, b).

    Alternates two star steps until nothing changes: each node's larger neighbours are tied to its
    least neighbour, then its smaller ones. Both keep components and bring every path to length one
    in about log rounds. A hub's rows are only ever grouped by partial minimum or joined, never
    gathered. Each round is written to the shared folder, and the one before it deleted.
    """
    e = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, "links")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        release(before)
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == mark:
            break
        mark = row
    out = written(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    release(e)
    return out


def joined_components(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component; a written table, which goes) with further links between their nodes or others.

    Only the links' ends, contracted to their components, go through the union-find.
    """
    a, b = components.toDF("a", "u"), components.toDF("b", "v")
    ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("u", "a").alias("a"), F.coalesce("v", "b").alias("b"))
    tied = connected_components(ends)
    moved = components.join(tied.toDF("component", "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    out = written(moved.unionByName(tied.join(components, "node", "left_anti")), "components")
    release(tied, components)
    return out
