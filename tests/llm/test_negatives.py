"""Hard negatives against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fonolith.llm import hard_negatives as hn
from tests.compare import same_as_sql

ROWS = "id long, label long, e array<float>"


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return tuple(math.floor(256 * x) for x in v)


def naive(rows, anchors, positives=5, negatives=10):
    """Rows (id, label, vector) to the sorted result."""
    rows = sorted({(i, a, v) for i, a, v in ((i, a, whole(v)) for i, a, v in rows) if i is not None and a is not None and v is not None})
    dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
    out = []
    for i, a, v in rows:
        if anchors(i):
            near = sorted((-dot(v, w), j, b) for j, b, w in rows if j != i and len(w) == len(v))
            for s, p in [(-s, j) for s, j, b in near if b == a][:positives]:
                hard = [(j, -t) for t, j, b in near if b != a and 30 * s <= -100 * t <= 90 * s][:negatives]
                out += [(i, p, k + 1, j, s, t) for k, (j, t) in enumerate(hard)]
    return sorted(out)


def mined(df):
    return sorted(map(tuple, hn.mine_negatives(df.select("id", "label", hn.scaled(F.col("e")).alias("v"), F.lit(1).alias("n")), F.col("id") % 3 == 0).collect()))


def some_rows(rng):
    rows = [(i, rng.choice([0, 1, 2]), [rng.choice([0.0, 0.5, 1.0, 1.25]) + rng.random() * rng.choice([0, 1]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, i % 2, [1.0, 1.0, 1.0, 1.0]) for i in range(60)]  # ties
    rows += [(300, 1, [-1.0, -2.0, 0.0, 0.5]), (303, 1, [0.0] * 4), (306, None, [1.0] * 4), (None, 1, [1.0] * 4), (309, 0, None), (312, 0, [1.0, None, 1.0, 1.0]), (315, 0, [float("nan")] * 4)]
    rows += [(318, 0, [float("inf"), 1.0, 1.0, 1.0]), (321, 0, [1.0, 2.0]), (322, 1, [0.5, 0.5]), (324, 0, [2.0, 1.0]), (327, 0, []), (328, 1, []), (329, 0, [])]
    rows += [(330, 2, [30.0, 2.5, -7.0, 60.0]), (331, 2, [30.0, 2.5, -7.0, 60.0]), (332, 1, [15.0, 2.5, -7.0, 30.0]), (3, 1, [9.0, 9.0, 9.0, 9.0])]
    return rows + rows[:5] + [rows[10]] * 4


def test_edges(spark):
    rows = some_rows(random.Random(1))
    want = naive(rows, lambda i: i % 3 == 0)
    assert mined(spark.createDataFrame(rows, ROWS)) == want and len(want) > 500
    assert hn.mine_negatives(spark.createDataFrame([], "id long, label long, v array<bigint>"), F.lit(True)).count() == 0


def test_many_rings(spark, monkeypatch):
    """Several pivots, rings and blocks of few vectors, and few searches of a block."""
    for name, value in (("RING", 8), ("BLOCK", 4), ("SEARCHES", 3), ("FOR_PIVOT", 20)):
        monkeypatch.setattr(hn, name, value)
    rows = some_rows(random.Random(2))
    assert mined(spark.createDataFrame(rows, ROWS).repartition(4)) == naive(rows, lambda i: i % 3 == 0)


def test_too_large_components_take_no_part(spark):
    df = spark.createDataFrame([(1, 0, [1e30, 1.0]), (2, 0, [1e6, 1.0])], ROWS)
    assert [r.v for r in df.select(hn.scaled(F.col("e")).alias("v")).collect()] == [None, [256_000_000, 256]]


@pytest.mark.parametrize("wide", [False, True])
def test_exact_products(wide):
    import numpy as np

    a = np.array([[2**30 + 1, 3], [5, -7]]) if wide else np.array([[3, 4], [5, -7]])
    assert hn.products(a, a).tolist() == [[int(sum(int(p) * int(q) for p, q in zip(x, y, strict=True))) for y in a] for x in a]


def test_sql(spark, duck):
    assert len(same_as_sql(spark, duck, hn.op12_hard_negatives, hn.OP12_SQL))
