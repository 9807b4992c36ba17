"""Near-duplicate vectors by spherical-cap filters.

Filter directions are structured: a random product code, whose directions are all pairs of a unit vector for the first
half of the dimensions and one for the second.  Each vector is list-decoded to all directions it exceeds a threshold on,
by sorting the scores of the halves, without a pass over all pairs.  Vectors meet in the filters they share, and cosines
are verified in double precision.  The number of filters follows the number of vectors, so that a filter holds about as
many at any size; filters that hold more are cut in blocks which meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm.common import join_checked, materialize
from fonolith.llm.graph import components
from fonolith.workers import ready

COSINE = 0.9
#: Filters that a vector exceeds and vectors in a filter, on average; the fewest filters; vectors compared in one task.
LISTED, HELD, LEAST_FILTERS, BLOCK = 16, 160, 256, 1024
#: The least share of pairs at exactly the cosine bound that meet in a filter, as simulated; pairs to simulate.
RECALL, SIMULATED = 0.97, 600
#: A vector that exceeds fewer directions is listed in its best ones, this many.
LEAST_LISTED = 14
#: Components are rounded to multiples of 1/GRID for the filters: sums are exact then, and a vector is decoded alike anywhere.
GRID = 2.0**20


class Filters:
    """The filters for n vectors of one dimension, with a threshold that pairs at the cosine bound meet often enough."""

    def __init__(self, n: int, dim: int, cosine: float = COSINE, seed: int = 23) -> None:
        want = max(LEAST_FILTERS, n * LISTED // HELD)
        self.size = int(np.ceil(np.sqrt(want)))
        rng, self.half = np.random.default_rng([seed, dim]), max(1, dim // 2)
        unit = lambda k: (lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300))(rng.normal(size=(self.size, k)))
        self.codes = np.rint(unit(self.half) * GRID), np.rint(unit(dim - self.half) * GRID) if dim > 1 else np.zeros((self.size, 0))
        # a direction is the pair of unit vectors over sqrt(2); its product with a random unit vector has spread 1/sqrt(dim)
        self.least = NormalDist().inv_cdf(1 - min(0.5, LISTED / self.size**2)) * np.sqrt(2 / dim) * GRID**2
        x, z = rng.normal(size=(2, SIMULATED, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        y = cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        while self.met(x, y) < RECALL and self.least > 0.02 * GRID**2:
            self.least *= 0.98

    def met(self, x: np.ndarray, y: np.ndarray) -> float:
        """The share of rows of x and y that have a filter in common."""
        code = lambda v: (lambda r, f: r * self.size**2 + f)(*self.decode(v))
        return len(np.unique(np.intersect1d(code(x), code(y)) // self.size**2)) / len(x)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and filters, in the order of rows and then of filters: all directions that exceed the threshold."""
        rows, found = [], []
        for a in range(0, len(x), 512):
            part = np.rint(x[a : a + 512] * GRID)
            first, second = part[:, : self.half] @ self.codes[0].T, part[:, self.half :] @ self.codes[1].T
            by = np.argsort(-second, axis=1, kind="stable")
            top = np.take_along_axis(second, by, 1)
            # each vector's own bar: the threshold, or lower so that at least LEAST_LISTED directions exceed it
            few = np.sort((np.sort(first, axis=1)[:, ::-1][:, :LEAST_LISTED, None] + top[:, None, :LEAST_LISTED]).reshape(len(part), -1), axis=1)
            bar = np.minimum(self.least, few[:, -min(LEAST_LISTED, few.shape[1])])
            i, c = np.nonzero(first + top[:, :1] >= bar[:, None])  # halves that reach it with the best other half
            need = bar[i] - first[i, c]
            low, high = np.zeros(len(i), int), np.full(len(i), self.size)
            while (low < high).any():  # how many of the sorted other halves do
                mid = (low + high) // 2
                ok = (mid < self.size) & (low < high)
                ok[ok] = top[i[ok], mid[ok]] >= need[ok]
                low, high = np.where(ok, mid + 1, low), np.where(ok, high, np.minimum(high, mid))
            many = low
            r = np.repeat(np.arange(len(i)), many)
            place = np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many)
            rows.append(i[r] + a)
            found.append(c[r] * self.size + by[i[r], place])
        rows, found = (np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for v in (rows, found))
        order = np.lexsort((found, rows))
        return rows[order], found[order]


def unit_rows(blobs: Iterable[bytes], dim: int, kind: type = np.float64) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, against overflow and underflow."""
    x = np.frombuffer(b"".join(blobs), kind).reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def linked_in(filters: Filters, f: int, x: np.ndarray, block: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of the rows of x in filter f with a cosine of at least `cosine`, less those that share an earlier filter.

    block: 0 or 1; if both occur, only pairs of one of each count.
    """
    near = np.triu(x @ x.T >= cosine, 1)
    if block.any():
        near &= block[:, None] != block[None]
    i, j = np.nonzero(near)
    if not len(i):
        return i, j
    some = np.unique(np.concatenate([i, j]))
    rows, listed = filters.decode(x[some])
    rows, listed = rows[listed < f], listed[listed < f]
    seen = np.zeros((len(some), len(some)), np.float32)
    names, column = np.unique(listed, return_inverse=True)
    for a in range(0, len(names), 2048):
        inside = (column >= a) & (column < a + 2048)
        has = np.zeros((len(some), min(2048, len(names) - a)), np.float32)
        has[rows[inside], column[inside] - a] = 1
        seen += has @ has.T
    new = seen[np.searchsorted(some, i), np.searchsorted(some, j)] == 0
    return i[new], j[new]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number that each of n nodes is joined to by the pairs."""
    at = np.arange(n)
    while len(i):
        low = np.minimum(at[i], at[j])
        np.minimum.at(at, i, low)
        np.minimum.at(at, j, low)
        np.minimum.at(at, at[i], low)
        at = at[at]
        open_ = at[i] != at[j]
        i, j = i[open_], j[open_]
    while (at[at] != at).any():
        at = at[at]
    return at


def link_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept), a row for each row of vectors.

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing, and so do rows with a
    null key (their component is null and kept false); vectors of different lengths don't link.  Equal vectors are one
    class whose rows all link with each other; only classes are compared.  An empty table gives an empty table.
    """
    ready(vectors.sparkSession)
    small = dict(vectors.dtypes)[column] == "array<float>"
    kind = np.float32 if small else np.float64
    v = F.col(column) if small else F.col(column).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).withColumn("ok", usable(F.col("v")) & F.col("id").isNotNull())
    hashed = rows.select("id", "ok", F.xxhash64(F.lit(1), "v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"), "v")
    # a class has a number of its own once it is written: several may have the same smallest id, or share one of the hashes
    classes = materialize(hashed.where("ok").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.min_by("v", "id").alias("v")).withColumn("cls", F.monotonically_increasing_id()))
    per_dim = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    shared = vectors.sparkSession.sparkContext.broadcast({d: Filters(n, d, cosine) for d, n in per_dim.items()})

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                blobs = [np.asarray(x, kind).tobytes() for x in part["v"]]
                r, found = shared.value[dim].decode(unit_rows(blobs, dim, kind))
                yield pd.DataFrame({"dim": dim, "f": found, "cls": part["cls"].to_numpy()[r], "n": part["n"].to_numpy()[r], "v": [blobs[k] for k in r]})

    members = materialize(classes.select("cls", "n", "v").mapInPandas(listed, "dim int, f long, cls long, n long, v binary"))
    large = materialize(members.groupBy("dim", "f").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK).select("dim", "f", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    cut = join_checked(members, large, ["dim", "f"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64(F.lit(9), "cls"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("dim", "f", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "cls", "n", "v")

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        dim, f, b1, b2 = (int(group[c].iloc[0]) for c in ("dim", "f", "b1", "b2"))
        if len(group) < 2:
            return pd.DataFrame({"cls": [], "links": [], "root": []}).astype("int64")
        group = group.sort_values("cls", kind="stable")
        x = unit_rows(group["v"], dim, kind)
        i, j = linked_in(shared.value[dim], f, x, (group["own"].to_numpy() != b1) if b1 != b2 else np.zeros(len(x), bool), cosine)
        n, cls = group["n"].to_numpy(), group["cls"].to_numpy()
        links = np.bincount(i, n[j], len(x)).astype(np.int64) + np.bincount(j, n[i], len(x)).astype(np.int64)
        some = np.flatnonzero(links)
        return pd.DataFrame({"cls": cls[some], "links": links[some], "root": cls[roots(len(x), i, j)][some]})

    found = materialize(cut.groupBy("dim", "f", "b1", "b2").applyInPandas(verify, "cls long, links long, root long"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    # components of classes, then their smallest member
    named = classes.select("cls", "h1", "h2", "rep", "n").join(links, "cls", "left").join(joined, classes.cls == joined.id, "left").withColumn("component", F.coalesce("component", "cls")).drop("id")
    named = materialize(named)
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = named.join(least, "component").select("h1", "h2", "n", "links", "component_id")
    out = hashed.drop("v").join(by_class.withColumn("ok", F.lit(True)), ["h1", "h2", "ok"], "left")
    n_links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), n_links.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: The same result in DuckDB's SQL, from all pairs.
OP6_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""
