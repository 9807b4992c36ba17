"""Speech tables derived from the driver's tables, with the same defects every time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fonolith.operators.scans import dealt
from fonolith.schema import TASK_BYTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(audio_id, seg, wi, word_idx, word, start_ms, end_ms): the tokens of each conversation, spoken one after the other."""
    tokens = F.filter(F.split("text", "[ \t\r\n]+"), lambda t: t != "")
    # texts are dealt, not their many words
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("audio_id"), F.col("turn").alias("seg"), "text")
    each = dealt(turns, "audio_id", F.octet_length("text"), TASK_BYTES).select("audio_id", "seg", F.posexplode(tokens).alias("wi", "word"))
    beat = F.col("seg") * 31 + F.col("wi") * 7
    duration = 80 + 45 * F.least(F.length("word"), F.lit(12))
    gap = F.when(beat % 11 == 0, 300).when(beat % 5 == 0, 40).otherwise(0)
    order = Window.partitionBy("audio_id").orderBy("seg", "wi")
    timed = each.withColumn("end_ms", F.sum(gap + duration).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    timed = timed.withColumn("word_idx", (F.row_number().over(order) - 1).cast("bigint"))
    return timed.select("audio_id", "seg", "wi", "word_idx", "word", (F.col("end_ms") - duration).cast("bigint").alias("start_ms"), "end_ms")


def raw_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """words with tokens that are blank, lack a time or have no duration."""
    i = F.col("word_idx")
    return words(spark, sf_dir).select(
        "audio_id", "word_idx",
        F.when(i % 31 == 7, " ").when(i % 17 == 3, F.concat(F.lit(" "), "word")).otherwise(F.col("word")).alias("word"),
        F.when(i % 23 != 5, F.col("start_ms")).alias("start_ms"),
        F.when(i % 37 == 11, None).when(i % 29 == 2, F.col("start_ms")).otherwise(F.col("end_ms")).alias("end_ms"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(audio_id, seg, text, start_ms, end_ms, words): one for each turn; some lack words or an end, or have no duration."""
    a, t = F.col("audio_id"), F.col("seg")
    spoken = words(spark, sf_dir).groupBy("audio_id", "seg").agg(F.array_sort(F.collect_list(F.struct("wi", "word", "start_ms", "end_ms"))).alias("w"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("last"))
    texts = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("audio_id"), F.col("turn").alias("seg"), "text")
    strip_place = F.transform("w", lambda x: F.struct(x["word"].alias("word"), x["start_ms"].alias("start_ms"), x["end_ms"].alias("end_ms")))
    none = F.array().cast("array<struct<word:string,start_ms:bigint,end_ms:bigint>>")
    end = F.when((a * 7 + t) % 17 == 0, None).when((a + t * 5) % 19 == 0, F.col("start_ms")).otherwise(F.col("last"))
    return texts.join(spoken, ["audio_id", "seg"]).select("audio_id", "seg", "text", "start_ms", end.alias("end_ms"), F.when((a + t) % 13 == 0, none).otherwise(strip_place).alias("words"))


def audio_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(audio_id, audio_file): a file name from the first words of each conversation."""
    first = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("audio_id")).agg(F.min_by("text", "turn").alias("text"))
    return first.select("audio_id", F.concat(F.lit("audio/"), F.translate(F.left("text", F.lit(6)), "/.\n", "---"), F.lit("_"), F.col("audio_id").cast("string"), F.lit(".mp3")).alias("audio_file"))


def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(audio_id, seq, viseme, start_ms, end_ms): spans that overlap and cover each other, from the table events."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", micros.alias("us"))
    least = events.agg(F.min("us").alias("us0"))
    start = F.expr("(us - us0) div 1000")
    spans = events.join(F.broadcast(least)).select(F.col("user_id").alias("audio_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("viseme"), start.alias("start_ms"), "value")
    return spans.select("audio_id", "seq", "viseme", "start_ms", (F.col("start_ms") + F.round(F.col("value") * 100).cast("bigint") * 3000).alias("end_ms"))


def clip_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prefix, name, is_file): names of existing clips, some malformed, from the table part."""
    prefix: Column = F.rpad(F.lower(F.regexp_replace("p_name", "[^A-Za-z0-9]", "")), 4, "x")
    digits = F.when(F.col("p_partkey") % 10 == 0, F.right(F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit(5))).otherwise(F.lpad(F.col("p_partkey").cast("string"), 6, "0"))
    return table(spark, sf_dir, "part").select(prefix.alias("prefix"), F.concat(prefix, F.lit("_"), digits, F.lit(".wav")).alias("name"), (F.col("p_partkey") % 7 != 0).alias("is_file"))
