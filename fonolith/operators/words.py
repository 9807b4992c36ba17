"""Words of a recording: which count, their order, their shapes, and the transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fonolith.functions.pronunciation import shape_codes
from fonolith.functions.text import is_word, join_plain, normalize_word, strip
from fonolith.operators.scans import apart, running
from fonolith.operators.spans import dealt_spans


def valid_words(words: DataFrame, long: DataFrame | None = None) -> DataFrame:
    """Stripped tokens with a duration, numbered by time (equal times keep their order); long: see merge_adjacent()."""
    kept = words.withColumn("word", strip(F.col("word"))).where("word <> '' and end_ms > start_ms")
    short, rest = apart(kept, "audio_id", long)
    by = [F.col(c) for c in ("start_ms", "end_ms", "word_idx")]
    place = short.withColumn("place", F.row_number().over(Window.partitionBy("audio_id").orderBy(*by)).cast("long"))
    if rest is not None:
        place = place.unionByName(running(rest, "audio_id", by, place=("sum", F.lit(1).cast("long"))))
    return place.withColumn("word_idx", (F.col("place") - 1).cast("bigint")).drop("place")


def with_visemes(words: DataFrame) -> DataFrame:
    """words with norm (normalized) and codes (their shapes, see shape_codes()); words that normalize to nothing go."""
    # a filter on norm would compute it once more
    rows = words.where(is_word(F.col("word"))).withColumn("norm", normalize_word(F.col("word")))
    return rows.withColumn("codes", shape_codes(F.col("norm")))


def spans_of(words: DataFrame) -> DataFrame:
    """(audio_id, seq, viseme, start_ms, end_ms) of with_visemes(); seq has the order of words and of spans in a word."""
    rows = dealt_spans(words, "audio_id", "word_idx")
    return rows.select("audio_id", F.struct("word_idx", "k").alias("seq"), "viseme", "start_ms", "end_ms")


def transcripts(segments: DataFrame, words: DataFrame) -> DataFrame:
    """(audio_id, transcript): the segments' texts in order, or the words if no segment has text."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("seg", "t"))), lambda x: x["t"])
    by_text = segments.withColumn("t", strip(F.coalesce("text", F.lit("")))).where("t <> ''").groupBy("audio_id").agg(F.array_join(texts, " ").alias("by_text"))
    tokens = F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "word"))), lambda x: x["word"])
    by_word = words.groupBy("audio_id").agg(join_plain(tokens).alias("by_word"))
    return by_word.join(by_text, "audio_id", "full").select("audio_id", F.coalesce("by_text", "by_word", F.lit("")).alias("transcript"))
