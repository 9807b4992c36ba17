"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fonolith.llm.common import drop_files, materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the nodes of edges (a, b): component is the smallest id that can be reached.

    Each round every node moves to the neighbour (or itself) that comes first in a random order, and edges are rewritten
    to where their ends went; without edges left, all nodes of a component are in one place.  The random order lets the
    number of edges shrink by a factor each round, also on chains.  Rounds are written to the shared folder; nothing but
    counts reaches the driver.
    """
    order = lambda c: F.struct(F.xxhash64(F.lit(17), c).alias("h"), F.col(c).alias("id"))
    live = materialize(edges.where("a <> b").select("a", "b").distinct())
    place = None
    while live.limit(1).count():
        both = live.select("a", "b").union(live.select("b", "a"))
        first = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", order("a"))["id"].alias("to"))
        first = materialize(first)
        moves = first.select(F.col("node").alias("id"), F.col("to").alias("at"))
        if place is not None:
            old, moves = place, materialize(place.join(first, place.at == first.node, "left").select("id", F.coalesce("to", "at").alias("at")))
            drop_files(old)
        fa, fb = first.select(F.col("node").alias("a"), F.col("to").alias("ta")), first.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        left = materialize(live.join(fa, "a").join(fb, "b").where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        drop_files(live)
        live, place = left, moves
    if place is None:
        return live.select(F.col("a").alias("id"), F.col("b").alias("component"))
    least = place.groupBy("at").agg(F.min("id").alias("component"))
    return materialize(place.join(least, "at").select("id", "component"))
