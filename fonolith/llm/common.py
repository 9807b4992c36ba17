"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.storage import drop_files, materialize  # noqa: F401

#: Characters that separate words, as in the pattern [^\x20\x09-\x0D]+ (a fixed value).
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it inside the lambda of another array function."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text (runs without BLANKS), as an array; null counts as empty."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """docs with all columns in one struct, fr_row, and the named ones beside it: no other name can clash with new columns."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("fr_row"), *names)


def join_checked(left: DataFrame, right: DataFrame, on, how: str = "left", rows: int = 100_000, size: Column | None = None, most: int = 1_000_000) -> DataFrame:
    """left joined to a small right side: broadcast if right has at most `rows` rows (it is counted), else shuffled.

    size: the number of values in a row of right, whose sum must be at most `most` too.  In the second case adaptive
    execution splits skewed partitions of left.
    """
    small = right.limit(rows + 1).count() <= rows
    if small and size is not None:
        small = (right.agg(F.sum(size)).first()[0] or 0) <= most
    return left.join(F.broadcast(right) if small else right, on, how)


def by_chance(share: Column, seed: int, *keys: str) -> Column:
    """Whether a row is drawn, with the given probability, by all bits of the hash of its keys."""
    return F.xxhash64(F.lit(seed), *keys).cast("double") / F.lit(2.0**64) + 0.5 < share


def group_count(spark: SparkSession, size: int, target: int) -> int:
    """Groups of about `target` bytes for so many bytes; of fewer, down to a sixteenth, where else some cores would idle."""
    idle = min(2 * spark.sparkContext.defaultParallelism, -(-size // max(1, target // 16)))
    return max(1, -(-size // target), idle)


def dealing(spark: SparkSession, size: int, group: int, held: int = 256 << 20, blob: int = 1 << 10) -> tuple[int, int]:
    """(groups, ranges) for so many bytes of texts, where each group sends each range a blob.

    A range stands for at most about `held` bytes of texts, so ranges follow the input; groups have about `group` bytes, or
    more where blobs would be smaller than `blob` bytes else (from some 2 TB on).
    """
    ranges = max(16, -(-size // held))
    groups = group_count(spark, size, max(group, ranges * blob))
    return groups, max(ranges, min(groups, 4096))
