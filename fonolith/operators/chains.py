"""Greedy cuts of long sequences: where each part begins depends on the part before, yet all are found without a fold.

Every element names the one that a part would begin with after a part that begins with it.  Following these pointers from the
first element gives the cuts; pointers are composed with themselves, so twice as many cuts are known after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fonolith.operators.scans import running
from fonolith.storage import drop_files, materialize


def reached(steps: DataFrame) -> DataFrame:
    """(key, at): of steps (key, at, next), next being larger than at or null, those that the first one of its key leads to."""
    marked = materialize(steps.groupBy("key").agg(F.min("at").alias("at")))
    jump = materialize(steps.where("next is not null").select("key", "at", "next"))
    while jump.limit(1).count():
        old = (marked, jump)
        marked = materialize(marked.unionByName(marked.join(jump, ["key", "at"]).select("key", F.col("next").alias("at"))))
        further = jump.select("key", F.col("at").alias("next"), F.col("next").alias("then"))
        jump = materialize(jump.join(further, ["key", "next"]).select("key", "at", F.col("then").alias("next")))
        for done in old:
            drop_files(done)
    return marked


def disordered(rows: DataFrame) -> DataFrame:
    """(key): those of rows (key, at, start_ms, end_ms) that lack a time or have an end before an earlier one's."""
    before = running(rows, "key", [F.col("at")], before=True, reach=("max", F.col("end_ms")))
    return before.where("start_ms is null or end_ms is null or end_ms < reach").select("key").distinct()


def greedy_starts(rows: DataFrame, least: int, alone: bool) -> DataFrame:
    """(key, at): where parts begin of rows (key, at, start_ms, end_ms), at counting by one and ends in order (see disordered()).

    A part takes in rows up to the first that ends `least` or more after the part's start, and that row too; with alone False that
    row begins the next part, unless it is the part's only one.
    """
    ends = rows.select("key", F.col("end_ms").alias("value"), F.lit(0).alias("kind"), "at")
    asked = rows.select("key", (F.col("start_ms") + least).alias("value"), F.lit(1).alias("kind"), "at")
    # from the largest value down, the least row so far is the first that ends there or later
    order = [F.col("value").desc(), F.col("kind"), F.col("at")]
    found = running(ends.unionByName(asked), "key", order, first=("max", F.when(F.col("kind") == 0, -F.col("at")))).where("kind = 1")
    last = rows.groupBy("key").agg(F.max("at").alias("last"))
    first = -F.col("first")
    following = F.greatest(first, F.col("at")) + 1 if alone else F.greatest(first, F.col("at") + 1)
    steps = found.join(last, "key").select("key", "at", F.when(first.isNotNull() & (following <= F.col("last")), following).alias("next"))
    return reached(materialize(steps))
