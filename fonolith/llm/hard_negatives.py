"""Hard negatives by one-dimensional distance keys.

The largest inner products with a vector q become the nearest neighbours of (q, 0) once each vector x is augmented by one
component, sqrt(top - |x|^2), that gives all the same length.  Some vectors, drawn at random, are pivots; each vector belongs to
its nearest pivot, and is stored in the order of (pivot, distance to it), cut in rings of equal width.  By the triangle
inequality a vector within r of q has a distance to its pivot that differs from q's own by at most r.  So a search scans, for
each pivot, an interval of keys around q's distance, and widens it: first what the intervals of width 0 hold (or, where
scores have an upper bound, its radius), then half the way to the k-th best so far, then all that is nearer than that.  Once the
radius reaches the k-th best distance nothing else can be among the first k.  Each round scans only the annuli that the last
one didn't, rings of too many vectors and rings that too many searches ask for in blocks.

Scores are exact integers: inner products in double precision where these hold them, else in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fonolith.llm.common import by_chance, drop_files, join_checked, materialize
from fonolith.workers import ready

#: Of the contract: factor of components, positives of an anchor, negatives of a positive, bounds of their scores in tenths.
SCALE, POSITIVES, NEGATIVES, LEAST, MOST = 256, 5, 10, 3, 9
#: Vectors in a ring, on average, and in a block of a ring at most (about); searches of a block; vectors for each pivot; most pivots.
RING, BLOCK, SEARCHES, FOR_PIVOT, PIVOTS = 1024, 2048, 1024, 4096, 256
_VECTOR = "array<bigint>"


def scaled(vector: Column) -> Column:
    """The components as whole numbers, floor(SCALE * x); null for a vector that is null or that scores can't be computed of."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    most = F.sqrt(F.lit(2.0**63) / F.greatest(F.size(vector), F.lit(1))) - 2
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE > most))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.int64) if dim else np.zeros((len(vectors), 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers that fit into 64 bits."""
    peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if peak < 2**53 else a @ b.T


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - (x.astype(np.float64) ** 2).sum(1), 0.0))


def _pivots(row) -> np.ndarray:
    return np.stack(row).astype(np.int64)


def index(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vectors, rings, pivots) of rows (id, label, dim, v, norm).

    vectors: (dim, pivot, ring, id, label, v), stored in the order of (dim, pivot, key).  rings: (dim, pivot, ring, n), those
    that hold vectors.  pivots: a row for each dim: top, the largest norm, the pivots' vectors (null: the origin is the only
    one) and their keys.  Pivots are drawn by their ids, about one for FOR_PIVOT vectors of a dim and PIVOTS at most, on average.
    """
    sizes = materialize(rows.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("top")))
    share = F.least(F.lit(1.0), F.least(F.lit(float(PIVOTS)), F.ceil(F.col("n") / FOR_PIVOT)) / F.col("n"))
    drawn = join_checked(rows, sizes.drop("top"), "dim", "inner").where(by_chance(share, 41, "id", "v"))
    pivots = materialize(sizes.join(drawn.groupBy("dim").agg(F.collect_list("v").alias("pivots")), "dim", "left").select("dim", "top", "pivots"))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x, top = _matrix(part["v"], dim), float(part["top"].iloc[0])
                if part["pivots"].iloc[0] is None:
                    pivot, key = np.zeros(len(x), int), np.full(len(x), np.sqrt(top))
                else:
                    p = _pivots(part["pivots"].iloc[0])
                    d = np.sqrt(np.maximum(2 * top - 2 * (x.astype(np.float64) @ p.astype(np.float64).T + np.outer(_augmented(x, top), _augmented(p, top))), 0.0))
                    pivot = d.argmin(1)
                    key = d[np.arange(len(x)), pivot]
                yield pd.DataFrame({"dim": dim, "pivot": pivot, "key": key, "id": part["id"], "label": part["label"], "v": part["v"]})

    keyed = _with_pivots(rows.select("id", "label", "dim", "v"), pivots).mapInPandas(nearest, f"dim int, pivot int, key double, id long, label long, v {_VECTOR}")
    stored = materialize(keyed.repartitionByRange("dim", "pivot", "key").sortWithinPartitions("dim", "pivot", "key"))
    reach = stored.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    rings = F.ceil(F.col("n") / RING).cast("int")
    reach = materialize(reach.select("dim", "pivot", "low", F.when(F.col("high") > F.col("low"), (F.col("high") - F.col("low")) / rings).otherwise(1.0).alias("width"), rings.alias("rings")))
    ringed = join_checked(stored, reach, ["dim", "pivot"], "inner").withColumn("ring", F.least(_ring(F.col("key")), F.col("rings") - 1)).drop("low", "width", "rings", "key")
    pivots = pivots.join(reach.groupBy("dim").agg(F.collect_list(F.struct("pivot", "low", "width", "rings")).alias("reach")), "dim")
    return ringed, materialize(ringed.groupBy("dim", "pivot", "ring").agg(F.count("*").alias("n"))), materialize(pivots)


def _with_pivots(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    return join_checked(rows, pivots, "dim", "inner", size=F.coalesce(F.size("pivots"), F.lit(1)) * F.col("dim"))


def _ring(key: Column) -> Column:
    """The ring of a key, of columns low, width and rings."""
    return F.least(F.greatest(F.floor((key - F.col("low")) / F.col("width")), F.lit(-1)), F.col("rings")).cast("int")


def first_k(searches: DataFrame, vectors: DataFrame, rings: DataFrame, pivots: DataFrame, k: int, same: bool) -> DataFrame:
    """(q, score, id): the first k partners of each search, by score (downwards) and id, in any order of rows.

    searches: (q, anchor, dim, label, v, norm, least, most), q unique.  Partners are vectors of another id and the same label, or
    another one (same false), with a score from least to most (null: no bound).
    """
    def distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                q, top = _matrix(part["v"], dim), float(part["top"].iloc[0])
                p = np.zeros((1, dim), np.int64) if part["pivots"].iloc[0] is None else _pivots(part["pivots"].iloc[0])
                d = np.sqrt(np.maximum(part["norm"].to_numpy(np.float64)[:, None] + top - 2.0 * products(q, p), 0.0))
                reach = part["reach"].iloc[0]
                yield pd.DataFrame({"q": np.repeat(part["q"].to_numpy(), len(reach)), **{c: np.tile([r[c] for r in reach], len(q)) for c in ("pivot", "low", "width", "rings")}, "at": d[:, [r["pivot"] for r in reach]].ravel()})

    near = materialize(_with_pivots(searches.select("q", "dim", "v", "norm"), pivots).mapInPandas(distances, "q long, pivot int, low double, width double, rings int, at double"))
    # a score's distance, by which the bounds of scores are radii too
    far = lambda score: F.sqrt(F.greatest(F.col("norm") + F.col("top") - 2.0 * score, F.lit(0.0)))
    asked = join_checked(searches, pivots.select("dim", "top"), "dim", "inner")
    inner = F.when(F.col("most").isNotNull(), far(F.col("most"))).otherwise(0.0)
    outer = F.when(F.col("least").isNotNull(), far(F.col("least"))).otherwise(float("inf"))
    # scanned: the radius that has been scanned; radius: the one to scan now; a radius of `end` reaches all rings
    low, high = F.col("low") + F.col("width"), F.col("low") + F.col("width") * (F.col("rings") - 1)
    end = near.groupBy("q").agg(F.max(F.greatest(F.col("at") - low, high - F.col("at"), F.lit(0.0))).alias("end"))
    state = materialize(asked.join(end, "q").select("q", "norm", "top", inner.alias("inner"), outer.alias("outer"), F.lit(-1.0).alias("scanned"), F.least(inner, outer).alias("radius"), "end"))
    narrow = searches.select("q", "anchor", "dim", "label", "v", "least", "most")
    found = materialize(searches.sparkSession.createDataFrame([], "q long, score long, id long"))
    while state.limit(1).count():
        slack = lambda c: F.col(c) + 1e-6 * (1 + F.col(c) + F.col("at"))
        ring = lambda c: F.sequence(F.greatest(F.lit(0), _ring(F.col("at") - slack(c))), F.least(F.col("rings") - 1, _ring(F.col("at") + slack(c))))
        inside = lambda c: (_ring(F.col("at") - slack(c)) < F.col("rings")) & (_ring(F.col("at") + slack(c)) >= 0)
        none = F.array().cast("array<int>")
        now = F.when(inside("radius"), ring("radius")).otherwise(none)
        old = F.when((F.col("scanned") >= 0) & inside("scanned"), ring("scanned")).otherwise(none)
        pairs = near.join(state, "q").withColumn("ring", F.explode(F.array_except(now, old)))
        pairs = pairs.where(F.col("at") + F.col("low") + (F.col("ring") + 1) * F.col("width") >= F.col("inner") * (1 - 1e-6) - 1e-6).select("q", "pivot", "ring")
        # of what has been found, the last of k says what another one must reach
        bound = found.groupBy("q").agg(F.when(F.count("*") >= k, F.min("score")).alias("reach"))
        pairs = materialize(pairs.join(narrow.join(bound, "q", "left"), "q"))
        new = _scanned(pairs, vectors, rings, k, same)
        order = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
        better = materialize(found.unionByName(new).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place"))
        last = better.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("score"))
        full = F.coalesce("n", F.lit(0)) >= k
        limit = F.least(F.when(full, far(F.col("score"))).otherwise(float("inf")), "outer", "end")
        # half the way to the bound after the first round, else all of it; without a bound three times as far
        wider = F.when(full & (F.col("scanned") < 0), (F.col("radius") + limit) / 2).when(full, limit).otherwise(F.least(limit, F.greatest(F.col("radius") * 3, F.col("end") / 8)))
        after = state.join(last, "q", "left").where(F.col("radius") < limit).select("q", "norm", "top", "inner", "outer", F.col("radius").alias("scanned"), wider.alias("radius"), "end")
        done = (state, found, pairs)
        state, found = materialize(after), better
        for d in done:
            drop_files(d)
    return found


def _scanned(pairs: DataFrame, vectors: DataFrame, rings: DataFrame, k: int, same: bool) -> DataFrame:
    """(q, score, id): the first k partners of each search in each block of the rings that pairs (q, ..., dim, pivot, ring) name."""
    wanted = pairs.groupBy("dim", "pivot", "ring").agg(F.count("*").alias("searches"))
    # blocks of a ring, and parts of the searches that ask for it
    work = rings.join(wanted, ["dim", "pivot", "ring"]).select("dim", "pivot", "ring", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("searches") / SEARCHES).cast("int").alias("parts"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = vectors.join(work, ["dim", "pivot", "ring"]).withColumn("block", F.pmod(F.xxhash64(F.lit(5), "id"), "blocks").cast("int")).withColumn("part", every("parts"))
    right = pairs.join(work, ["dim", "pivot", "ring"]).withColumn("part", F.pmod(F.xxhash64(F.lit(6), "q"), "parts").cast("int")).withColumn("block", every("blocks"))

    def scan(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"q": [], "score": [], "id": []}).astype("int64")
        dim, ids = int(x["dim"].iloc[0]), x["id"].to_numpy()
        score = products(_matrix(q["v"], dim), _matrix(x["v"], dim))
        alike = q["label"].to_numpy()[:, None] == x["label"].to_numpy()[None]
        ok = (alike if same else ~alike) & (q["anchor"].to_numpy()[:, None] != ids[None])
        whole = lambda c, none: np.array([none if v is None or v is pd.NA or v != v else int(v) for v in q[c]], np.int64)[:, None]
        low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        ok &= (score >= np.maximum(whole("least", low), whole("reach", low))) & (score <= whole("most", high))
        if len(ids) > k:
            # ties with the k-th best stay, to be told apart by id
            ok &= score >= -np.partition(-np.where(ok, score, low + 1), k - 1, axis=1)[:, k - 1 : k]
        i, j = np.nonzero(ok)
        order = np.lexsort((ids[j], -score[i, j], i))
        i, j = i[order], j[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        i, j = i[place < k], j[place < k]
        return pd.DataFrame({"q": q["q"].to_numpy()[i], "score": score[i, j], "id": ids[j]})

    by = ["dim", "pivot", "ring", "block", "part"]
    least = [F.col(c).cast("string").alias(c) for c in ("least", "most", "reach")]  # pandas would make doubles of longs with nulls
    left, right = left.select(*by, "id", "label", "v"), right.select(*by, "q", "anchor", "label", "v", *least)
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(scan, "q long, score long, id long")


def mine_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (id, label, v), v whole numbers.

    Each row that `anchors` (a condition) names is paired with the first rows of its own label, and each of these with the
    first rows of other labels whose score is between LEAST and MOST tenths of the positive's; first by score, which is the
    inner product with the anchor, and then by smaller id.  Rows with a null id, label or v take no part, and vectors of
    different lengths don't meet.  Rows that agree in all three count once; rows of an anchor's id are no partners of it.  Rows
    that agree in label and vector tie, so of these only the first ones, as many as can be among the first partners, are
    indexed.  An empty table gives an empty table.
    """
    spark = rows.sparkSession
    ready(spark)
    usable = rows.where("id is not null and label is not null and v is not null").select("id", "label", F.size("v").alias("dim"), "v").dropDuplicates(["id", "label", "v"])
    usable = materialize(usable.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))
    place = F.row_number().over(Window.partitionBy("dim", "label", "v").orderBy("id"))
    vectors, rings, pivots = index(usable.withColumn("place", place).where(F.col("place") <= max(positives + 1, negatives)).drop("place"))
    no = F.lit(None).cast("long")
    chosen = materialize(usable.where(anchors).withColumnRenamed("id", "anchor").withColumn("q", F.monotonically_increasing_id()))
    found = first_k(chosen.withColumn("least", no).withColumn("most", no), vectors, rings, pivots, positives, True)
    pairs = materialize(found.withColumnsRenamed({"score": "positive_score", "id": "positive_id", "q": "a"}))
    score = F.col("positive_score")
    # ceil(3/10 of the score) and floor(9/10 of it), without leaving 64 bits; no score is between those of a negative one
    tens, ones = F.expr("positive_score div 10"), F.col("positive_score") % 10
    asked = pairs.where("positive_score >= 0").select("a", "positive_score").distinct()
    asked = asked.select("a", "positive_score", (tens * LEAST + F.ceil(ones * LEAST / 10)).cast("long").alias("least"), (tens * MOST + F.floor(ones * MOST / 10)).cast("long").alias("most"))
    asked = materialize(asked.join(chosen.withColumnRenamed("q", "a"), "a").withColumn("q", F.monotonically_increasing_id()))
    hard = first_k(asked, vectors, rings, pivots, negatives, False)
    out = asked.select("q", "a", "anchor", "positive_score").join(hard, "q").join(pairs, ["a", "positive_score"])
    rank = F.row_number().over(Window.partitionBy("a", "positive_id", "positive_score").orderBy(F.col("score").desc(), "id"))
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", rank.alias("rank"), F.col("id").alias("negative_id"), score.alias("positive_score"), F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), label.alias("label"), scaled(F.col("embedding")).alias("v"))
    return mine_negatives(rows, F.col("id") % 100 == 0)


#: The same result in DuckDB's SQL, from all pairs of an anchor and a row.
OP12_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
n AS (SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LEAST} * positive_score <= 10 * score AND 10 * score <= {MOST} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
