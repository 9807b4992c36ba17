"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words.  All its documents get the same expected number of copies, target / size of the
source; the whole part is given to each, and the fractional parts are rounded against each other: neighbours in size are
paired, and words move between the two at random, keeping both expectations, until one part is integral; what stays
fractional is paired again.  Blocks of a source are rounded independently and hand on at most one fractional document
each; these meet again in blocks, level by level, until one is left, which is rounded alone.  So a source misses its
target by less than one document.  Random numbers come from document ids and texts, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import join_checked, materialize, packed, words
from fonolith.workers import ready

#: The weights of sources in order of code points, repeated; the share of all words to take; the most copies (the contract's).
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents rounded together in one block of the reduction tree.
FAN_IN = 4096
_NEAR = 1e-9


def _sums_before(rows: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """rows with, for each name, the sum of its column over all rows that come before in the order.

    Rows are sorted in parts; only one row for each part meets in one place.  The order must be total.
    """
    parts = materialize(rows.repartitionByRange(*order).withColumn("fr_part", F.spark_partition_id()))
    before = Window.orderBy("fr_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("fr_part").agg(*(F.sum(c).alias(f"of_{n}") for n, c in sums.items()))
    starts = starts.select("fr_part", *(F.coalesce(F.sum(f"of_{n}").over(before), F.lit(0)).alias(f"start_{n}") for n in sums))
    inside = Window.partitionBy("fr_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(F.broadcast(starts), "fr_part")
    for n, c in sums.items():
        out = out.withColumn(n, F.col(f"start_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.drop("fr_part", *(f"start_{n}" for n in sums))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, docs, source_size, target) of (source, size): shares by weight, none above `most` times its source's size.

    A source reaches its cap at the rate (words for a unit of weight) most * size / weight.  In the order of these rates,
    the sources before some place are capped and the others share what is left; sums before each place show where.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("docs"))
    ranked = _sums_before(sources, [F.col("source").asc_nulls_last()], rank=F.lit(1))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = materialize(ranked.select("source", "docs", "source_size", "rank", weight.alias("weight")))
    n = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, heavy = share * (n[0] or 0), n[1] or 0.0
    cap = F.col("source_size") * most / F.col("weight")
    met = _sums_before(table.withColumn("cap", cap), [F.col("cap"), F.col("rank")], capped_size=F.col("source_size"), capped_weight=F.col("weight"))
    rate = (F.lit(total) - F.col("capped_size") * most) / (F.lit(heavy) - F.col("capped_weight"))
    found = met.withColumn("rate", rate).where("cap >= rate").agg(F.min_by("rate", F.struct("cap", "rank"))).first()[0]
    full = F.col("source_size") * most
    return table.select("source", "docs", "source_size", (full if found is None else F.least(F.lit(float(found)) * F.col("weight"), full)).cast("double").alias("target"))


def pivot_pairs(size: np.ndarray, p: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds p (in (0, 1)) to 0 or 1 but for one entry, whose number is returned (-1: none is left).

    Neighbours meet in pairs: words move between the two at random until one is integral; those that stay fractional
    meet again.  The sum of size * p stays the same, and each p keeps its expectation.  seed: 64 random bits an entry.
    """
    out, turn = p.astype(np.float64), 0
    size, seed = size.astype(np.float64), seed.astype(np.uint64)
    done = (out < _NEAR) | (out > 1 - _NEAR)
    out[done] = np.round(out[done])
    live = np.flatnonzero(~done)
    while len(live) > 1:
        even = len(live) // 2 * 2
        a, b = live[:even:2], live[1:even:2]
        up = np.minimum((1 - out[a]) * size[a], out[b] * size[b])  # words that can move to a ...
        down = np.minimum(out[a] * size[a], (1 - out[b]) * size[b])  # ... and from it
        bits = tk.mix(tk.combine(seed[a], seed[b]) + np.uint64(turn))
        u = (bits >> np.uint64(11)).astype(np.float64) / 2.0**53
        move = np.where(u * (up + down) < down, up, -down)
        for at, q in ((a, out[a] + move / size[a]), (b, out[b] - move / size[b])):
            out[at] = np.where((q < _NEAR) | (q > 1 - _NEAR), np.round(q), q)
        live, turn = live[(out[live] > 0) & (out[live] < 1)], turn + 1
    return out, int(live[0]) if len(live) else -1


def _round(block: pa.Table) -> pa.Table:
    block = block.sort_by([("size", "descending"), ("id", "ascending"), ("place", "ascending")])
    column = lambda c: block.column(c).to_numpy()
    p, left = pivot_pairs(column("size"), column("p"), column("id").view(np.uint64))
    return pa.table([*(block.column(c) for c in ("place", "source", "docs", "size", "id")), pa.array(p), pa.array(np.arange(len(p)) == left)], names=["place", "source", "docs", "size", "id", "p", "open"])


def numbered(rows: DataFrame) -> DataFrame:
    """rows (place, key, source, size, h) with number: rows that agree in all but their place count from 0.

    They are counted by part of the table first, so that no key, null or other, gathers its rows in one task.
    """
    same = F.xxhash64(F.lit(3), "key", F.col("key").isNull(), "source", F.col("source").isNull(), "size", "h")
    rows = rows.withColumn("same", same).withColumn("part", F.shiftright("place", 33))
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy("same", "part").orderBy("place")) - 1)
    before = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("same", "part").agg(F.count("*").alias("n")).withColumn("start", F.sum("n").over(before)).where("start > 0").drop("n")
    rows = rows.join(starts, ["same", "part"], "left")
    return rows.withColumn("number", F.col("number") + F.coalesce("start", F.lit(0))).drop("part", "start")


def _at(key: Column, text: Column, source: Column) -> Column:
    """A row's place (unique and, once written, lasting), its key, source and size, and the hash of its text."""
    return F.struct(F.monotonically_increasing_id().alias("place"), key.alias("key"), source.alias("source"), F.size(words(text)).cast("long").alias("size"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))


def _copies(rows: DataFrame, seed: int, **mix) -> DataFrame:
    """(place, key, source, size, source_size, target, copies) of rows (place, key, source, size, h)."""
    targets = materialize(source_targets(rows, **mix))
    t = targets.select(F.col("source").alias("s"), "docs", "source_size", "target")
    rows = numbered(rows).withColumn("id", F.xxhash64(F.lit(seed), "same", "number")).drop("same", "number", "h")
    rows = join_checked(rows, t, F.col("source").eqNullSafe(F.col("s")), "inner").drop("s")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = materialize(rows.withColumn("whole", F.floor(expected).cast("long")).withColumn("p", expected - F.floor(expected)))
    split = (F.col("size") > 0) & (F.col("p") > _NEAR) & (F.col("p") < 1 - _NEAR)
    open_rows = rows.where(split).select("place", "source", "docs", "size", "id", "p")
    schema = "place long, source string, docs long, size long, id long, p double, open boolean"
    done = [rows.select("place", "p", F.lit(True).alias("open")).limit(0)]
    # a source's blocks follow its number of documents, so none is larger than about FAN_IN; each hands on one at most
    most = targets.agg(F.max("docs")).first()[0] or 0
    while most > 0:
        level, blocks = len(done), F.ceil(F.col("docs") / FAN_IN).cast("long")
        keyed = open_rows.withColumn("docs", blocks).withColumn("block", F.pmod(F.xxhash64(F.lit(seed + level), "id"), "docs"))
        rounded = materialize(keyed.groupBy("source", "block").applyInArrow(tk.lean(_round), schema))
        done.append(rounded.where("not open").select("place", "p", "open"))
        open_rows, most = rounded.where("open").drop("open"), -(-most // FAN_IN)
        if most == 1:
            u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / F.lit(2.0**53)
            done.append(open_rows.select("place", F.when(u < F.col("p"), 1.0).otherwise(0.0).alias("p"), F.lit(False).alias("open")))
            break
    bonus = done[0]
    for d in done[1:]:
        bonus = bonus.unionByName(d)
    out = rows.join(bonus.select("place", F.col("p").cast("int").alias("bonus")), "place", "left")
    rest = F.when(F.col("p") >= 1 - _NEAR, 1).otherwise(0)
    return out.select("place", "key", "source", "size", "source_size", "target", (F.col("whole") + F.coalesce("bonus", rest)).cast("long").alias("copies"))


def taken_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, **mix) -> DataFrame:
    """(<key>, source, size, source_size, target, copies): one row for each row of docs.

    Null or empty text has size 0 and gets the whole part of its expected copies.  Null source is a source of its own,
    last in order.  Rows that repeat a key (or have none) are documents of their own, told apart by source, size and
    text; rows that agree in these too share their copies in any order.  An empty table gives an empty table.  Very long
    texts are counted whole.
    """
    ready(docs.sparkSession)
    at = materialize(docs.select(_at(F.col(key), F.col(text), F.col(source)).alias("fr_at")))
    return _copies(at.select("fr_at.*"), seed, **mix).withColumnRenamed("key", key).drop("place")


def mix_documents(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with each row as often as it is taken, and the columns of docs.

    Null texts, sources and keys, repeated rows and empty tables: as in taken_copies().  Each row gets a place, written
    once with it; only narrow rows are numbered and rounded, and texts move once, to the copies of their place.
    """
    ready(docs.sparkSession)
    rows = materialize(packed(docs).withColumn("fr_at", _at(F.col(f"fr_row.`{key}`"), F.col("fr_row.text"), F.col("fr_row.source"))))
    copies = materialize(_copies(rows.select("fr_at.*"), 7).where("copies > 0").select("place", "copies"))
    # the narrow side is the hash table: texts aren't sorted
    taken = rows.withColumn("place", F.col("fr_at.place")).join(copies.hint("shuffle_hash"), "place")
    return taken.select("fr_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("fr_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return taken_copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
