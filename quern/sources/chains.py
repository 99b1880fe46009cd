"""Stored pages in the order in which their cursors lead from one to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.sinks.shared import stored


def chained(pages: DataFrame, starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(start, place, address) of the pages that cursors reach, and (address, reason) of those put aside.

    pages: address, next (null or empty: the last one); starts: start, the first address of each chain. Pointers
    double: after k rounds every page knows the one 2^k cursors on, so a chain of n pages takes log n rounds of
    two joins. A page that a chain meets again keeps its first place, and its repeat is the reason ``cycle`` of the
    page that leads back; pages that no chain meets are ``unreached``; a cursor to an address that isn't stored
    is ``missing``, under that address. Null and repeated addresses: the first of each by cursor, nulls none.
    """
    known = pages.where("address is not null").groupBy("address").agg(F.min(F.nullif("next", F.lit(""))).alias("next"))
    known = stored(known)
    jump = known.where("next is not null").select("address", F.col("next").alias("to"))
    reached = stored(starts.where("start is not null").distinct().join(known.select(F.col("address").alias("start")), "start").select("start", F.lit(0).cast("long").alias("place"), F.col("start").alias("address")))
    step, size = 1, reached.count()
    while size:
        on = reached.join(jump, "address").select("start", (F.col("place") + step).alias("place"), F.col("to").alias("address"))
        merged = stored(reached.unionByName(on).groupBy("start", "address").agg(F.min("place").alias("place")).select("start", "place", "address"))
        n = merged.count()
        reached, step = merged, step * 2
        if n == size:  # what can be reached in twice as many steps has been
            break
        size = n
        ahead = jump.select(F.col("address").alias("to"), F.col("to").alias("further"))
        jump = stored(jump.join(ahead, "to").select("address", F.col("further").alias("to")))
    inside = reached.join(known.select("address"), "address").select("start", "place", "address")
    following = inside.join(known, "address").where("next is not null").select("start", "place", "address", "next")
    back = following.join(inside.select("start", F.col("address").alias("next"), F.col("place").alias("met")), ["start", "next"]).where("met <= place")
    aside = back.select("address", F.lit("cycle").alias("reason"))
    aside = aside.unionByName(known.join(inside.select("address").distinct(), "address", "left_anti").select("address", F.lit("unreached").alias("reason")))
    aside = aside.unionByName(reached.join(known, "address", "left_anti").select("address", F.lit("missing").alias("reason")))
    return inside, aside.distinct()
