"""Running aggregates against plain windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fonolith.operators.scans import running


def test_running(spark):
    """Keys of one row, of most rows, and none, in an order with ties that a last column settles."""
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3 + i]), rng.choice([None, 1, 2, 3]), i, rng.choice([None, rng.randrange(-50, 50)])) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, a long, i long, v long").repartition(7, "i")
    order = [F.col("a").desc_nulls_last(), F.col("i")]
    for key in ("k", None):
        for before in (False, True):
            w = (Window.partitionBy(key) if key else Window.partitionBy(F.lit(1))).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
            want = df.select("*", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"), F.bit_xor("v").over(w).alias("x"), F.sum(F.lit(1)).over(w).alias("n"))
            got = running(df, key, order, before, s=("sum", F.col("v")), m=("max", F.col("v")), x=("xor", F.col("v")), n=("sum", F.lit(1)))
            assert got.columns == want.columns
            assert sorted(got.collect(), key=lambda r: r.i) == sorted(want.collect(), key=lambda r: r.i)
    assert running(df.limit(0), "k", order, s=("sum", F.col("v"))).count() == 0
    assert running(df.limit(0), None, order, s=("sum", F.col("v"))).count() == 0


def test_a_large_key_is_in_many_tasks(spark):
    df = spark.range(10_000).select(F.lit("one").alias("k"), F.col("id").alias("i"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running(df, "k", [F.col("i")], s=("sum", F.col("i"))).withColumn("task", F.spark_partition_id())
        assert got.groupBy("task").count().count() > 1
        assert got.where("s <> i * (i + 1) / 2").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dealt(spark, monkeypatch):
    """Tasks have a bounded share: their number follows the size, and the timeline keeps the dealing of its texts."""
    from fonolith.operators.scans import dealt
    from fonolith.plans.queries import QUERIES
    from fonolith.sources import derived

    rows = spark.range(1000).withColumn("k", F.col("id") % 100)
    by = dealt(rows, "k", F.lit(10), 100)
    assert by.rdd.getNumPartitions() == 100 and sorted(r.id for r in by.collect()) == list(range(1000))
    assert dealt(rows, "k", F.lit(None).cast("int"), 100).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    sf_dir = "/root/testdata/sf0.001"
    total = derived.table(spark, sf_dir, "conversations").agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(derived, "TASK_BYTES", 1000)
    for name in ("timeline_sil", "timeline_clamped"):
        assert QUERIES[name](spark, sf_dir).rdd.getNumPartitions() == -(-total // 1000)


def test_timeline_of_dealt_words(spark, monkeypatch):
    """Words of a payload's timeline are dealt before they are cut into spans; the spans are those of the query."""
    from fonolith.operators import scans
    from fonolith.plans import payload
    from fonolith.plans.queries import _timeline
    from fonolith.sources import derived

    asked = []
    monkeypatch.setattr(payload, "dealt", lambda rows, key, size, most: asked.append((rows.columns, most)) or scans.dealt(rows, key, size, 100))
    sf_dir = "/root/testdata/sf0.001"
    line = payload.recording_timeline(payload.shaped_words(derived.words(spark, sf_dir)))
    assert len(asked) == 1 and "word" in asked[0][0]
    want = _timeline(spark, sf_dir, True)
    assert sorted(map(tuple, line.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_mouth_cues_keep_the_dealing(spark, monkeypatch):
    """The payloads of cues are gathered where the texts were dealt, by as many tasks and without another exchange."""
    from fonolith.plans.queries import QUERIES
    from fonolith.sources import derived

    sf_dir = "/root/testdata/sf0.001"
    total = derived.table(spark, sf_dir, "conversations").agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(derived, "TASK_BYTES", 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = QUERIES["mouth_cue_payload"](spark, sf_dir)
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
        assert rows.rdd.getNumPartitions() == -(-total // 1000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_mouth_cues_of_more_recordings(spark, monkeypatch, tmp_path):
    """Six times the recordings give each its cues, and the largest task no larger share of them."""
    from fonolith.plans.queries import QUERIES
    from fonolith.sources import derived

    monkeypatch.setattr(derived, "TASK_BYTES", 8000)
    turns, least, times = derived.table(spark, "/root/testdata/sf0.001", "conversations"), 1_000_000, 6
    cues, most = {}, {}
    for n in (1, times):
        copies = turns.crossJoin(spark.range(n)).withColumn("conv_id", F.col("conv_id") + F.col("id") * least).drop("id")
        copies.write.parquet(f"{tmp_path}/{n}/conversations.parquet")
        rows = QUERIES["mouth_cue_payload"](spark, f"{tmp_path}/{n}").withColumn("task", F.spark_partition_id()).collect()
        cues[n] = {r.audio_id: r.cues for r in rows}
        most[n] = max(sum(len(r.cues) for r in rows if r.task == k) for k in {r.task for r in rows})
    assert cues[times] == {i + k * least: c for i, c in cues[1].items() for k in range(times)}
    assert most[times] < 2 * most[1]
