"""Building a speech dataset from transcript segments: checks, cut list, clip names, metadata and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from fonolith.functions.text import normalize_text, strip
from fonolith.schema import END_PADDING_MS, MIN_SEGMENT_MS

#: The reasons to skip a segment, in the order they are tried (fixed values).
REASONS = ("missing timestamps", "end <= start", "empty text", "too short", "too long")


def with_skip_reason(segments: DataFrame, shortest: int = MIN_SEGMENT_MS, longest: int | None = None) -> DataFrame:
    """segments with skip_reason: the first check that fails, null for a segment to export.

    The bounds themselves pass.  Times that are no numbers are null under the declared schema, so they count as missing.
    """
    length = F.col("end_ms") - F.col("start_ms")
    missing, reversed_, empty, short, long_ = REASONS
    reason = F.when(F.col("start_ms").isNull() | F.col("end_ms").isNull(), missing).when(length <= 0, reversed_)
    reason = reason.when(strip(F.coalesce("text", F.lit(""))) == "", empty).when(length < shortest, short)
    return segments.withColumn("skip_reason", reason.when(length > longest, long_) if longest is not None else reason)


def cut_list(segments: DataFrame, padding: int = END_PADDING_MS) -> DataFrame:
    """segments with cut_start_ms and cut_ms: from the first word's start to the last word's end and some padding.

    Segments without words, or whose first or last word lacks a time, are cut at their own bounds.
    """
    first, last = F.get("words", F.lit(0))["start_ms"], F.try_element_at("words", F.lit(-1))["end_ms"]
    own = first.isNotNull() & last.isNotNull()
    start = F.when(own, first).otherwise(F.col("start_ms"))
    end = F.when(own, last).otherwise(F.col("end_ms"))
    return segments.withColumn("cut_start_ms", start).withColumn("cut_ms", F.greatest(F.lit(0), end + padding - start))


def max_suffix(listing: DataFrame) -> DataFrame:
    """(prefix, max_idx): the largest six-digit number of the files prefix_NNNNNN.wav, 0 if there is none."""
    shape = F.concat(F.lit(r"^\Q"), F.col("prefix"), F.lit(r"\E_([0-9]{6})\.wav$"))
    number = F.nullif(F.call_function("regexp_extract", F.col("name"), shape, F.lit(1)), F.lit("")).cast("int")
    return listing.groupBy("prefix").agg(F.coalesce(F.max(F.when(F.col("is_file"), number)), F.lit(0)).alias("max_idx"))


def clip_names(segments: DataFrame, existing: DataFrame) -> DataFrame:
    """segments (audio_id, seg, prefix, ...) with clip_idx and filename, dense for each prefix from the existing number on.

    Files that share a prefix share a sequence, in the order of audio_id.  Segments are numbered within their recording;
    only the recordings' counts meet by prefix, so a frequent prefix doesn't gather its segments in one task.
    """
    per = segments.groupBy("prefix", "audio_id").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("prefix").orderBy("audio_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = per.withColumn("before", before).join(existing, "prefix", "left").select("prefix", "audio_id", (F.col("before") + F.coalesce("max_idx", F.lit(0))).alias("before"))
    own = F.row_number().over(Window.partitionBy("audio_id").orderBy("seg"))
    numbered = segments.withColumn("own", own).join(starts, ["prefix", "audio_id"])
    return numbered.withColumn("clip_idx", F.col("before") + F.col("own")).withColumn("filename", F.format_string("%s_%06d.wav", "prefix", "clip_idx")).drop("own", "before")


def metadata(clips: DataFrame, form: str = "classic") -> DataFrame:
    """The metadata columns: file name and normalized text for piper, with the raw text between them for any other form."""
    raw = strip(F.col("text"))
    columns = [F.col("filename"), raw.alias("raw_text"), normalize_text(raw).alias("norm_text")]
    return clips.select(*(columns[::2] if form == "piper" else columns))


def build_summary(segments: DataFrame, *more: str) -> DataFrame:
    """Counts of all, exported and skipped segments (with skip_reason), for each recording; more: other columns that it has one value of."""
    total, kept = F.count("*"), F.count_if(F.col("skip_reason").isNull())
    return segments.groupBy("audio_id", *more).agg(total.alias("total_segments"), kept.alias("exported_segments"), (total - kept).alias("skipped_segments"))


def skip_counts(segments: DataFrame, failed: str = "export failed") -> tuple[DataFrame, Observation]:
    """segments (with skip_reason), and counts of all, exported and skipped ones by reason, which come with whatever writes segments."""
    seen = Observation()
    counts = [F.count_if(F.col("skip_reason") == r).alias(r) for r in (*REASONS, failed)]
    return segments.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("skip_reason").isNull()).alias("exported"), *counts), seen
