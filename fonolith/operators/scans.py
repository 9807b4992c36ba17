"""Running aggregates in an order of rows, without one task for a key or for all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fonolith.storage import materialize

#: Keys that are broadcast at most.
_FEW = 100_000
#: Aggregates that may be made in parts, and how two parts are put together; null stands for no rows.
_JOINED: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "xor": (F.bit_xor, lambda a, b: F.coalesce(a.bitwiseXOR(b), a, b)),
}


def apart(rows: DataFrame, key: str, large: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """rows of keys that aren't among `large` (a table of keys), and those that are, or None if there are no such keys."""
    if large is None or not large.limit(1).count():
        return rows, None
    keys = large.select(F.col(key).alias("fr_large")).distinct()
    keys = F.broadcast(keys) if keys.limit(_FEW + 1).count() <= _FEW else keys
    same = rows[key].eqNullSafe(F.col("fr_large"))
    return rows.join(keys, same, "left_anti"), rows.join(keys, same, "left_semi")


def large_keys(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(key): those that more than so many rows have."""
    return materialize(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(key))


def dealt(rows: DataFrame, key: str, size: Column, most: int) -> DataFrame:
    """rows dealt by a key to as many tasks as leave each about so much of the total size, so that a task's memory doesn't grow with the input."""
    total = rows.agg(F.sum(size).alias("n")).first()["n"] or 0
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-int(total) // most)), key)


def running(rows: DataFrame, key: str | None, order: list[Column], before: bool = False, again: bool = False, **values: tuple[str, Column]) -> DataFrame:
    """rows with a column for each name: an aggregate ("sum", "max" or "xor") of a value over the rows of the same key so far.

    before: over the rows before this one only (null for the first).  key None: all rows are one key.  Rows are dealt by
    ranges of key and order, and sorted there; a key that spans several parts hands on one value for each part, so neither a
    key nor the whole table meets in one task.  The order should be total; rows of a null key are one key.  What is handed
    on, and broadcast, has at most two rows for each part.  again: the result keeps the number of its part (fr_part), and
    rows that have one, from before with the same key and order, aren't dealt anew.
    """
    by = [F.col(key), *order] if key else order
    parts = materialize(rows if "fr_part" in rows.columns else rows.repartitionByRange(*by).withColumn("fr_part", F.spark_partition_id()))
    own = [F.col(key).alias("fr_key")] if key else [F.lit(0).alias("fr_key")]
    narrow = parts.select("fr_part", *own, *(v.alias(f"of_{n}") for n, (_, v) in values.items()))
    if key:
        ends = narrow.groupBy("fr_part").agg(F.min("fr_key").alias("a"), F.max("fr_key").alias("z"), F.max(F.col("fr_key").isNull()).alias("none"))
        # a part begins and ends with a key (null is the first one), and only these may be in other parts too
        ends = ends.select("fr_part", F.explode(F.array_distinct(F.array("a", "z", F.when(F.col("none"), F.lit(None)).otherwise(F.col("a"))))).alias("fr_key"))
        several = ends.distinct().groupBy("fr_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("fr_key").alias("fr_several"))
        narrow = narrow.join(F.broadcast(several), F.col("fr_key").eqNullSafe(F.col("fr_several")), "left_semi")
    totals = narrow.groupBy("fr_part", "fr_key").agg(*(_JOINED[f][0](F.col(f"of_{n}")).alias(f"of_{n}") for n, (f, _) in values.items()))
    earlier = Window.partitionBy("fr_key").orderBy("fr_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(totals.select(F.col("fr_part").alias("fr_at"), "fr_key", *(_JOINED[f][0](F.col(f"of_{n}")).over(earlier).alias(f"of_{n}") for n, (f, _) in values.items())))
    same = F.col("fr_part") == F.col("fr_at")
    out = parts.join(F.broadcast(carried), same & F.col(key).eqNullSafe(F.col("fr_key")) if key else same, "left")
    inside = Window.partitionBy("fr_part", *([key] if key else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    for n, (f, v) in values.items():
        whole, joined = _JOINED[f]
        out = out.withColumn(n, joined(F.col(f"of_{n}"), whole(v).over(inside)))
    return out.drop(*([] if again else ["fr_part"]), "fr_at", "fr_key", *(f"of_{n}" for n in values))
