"""The three pipelines, from transcript documents to their outputs, with their options."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.errors import PipelineError
from fonolith.functions.text import audio_prefix, normalize_word
from fonolith.operators import dataset, phrases
from fonolith.operators.scans import large_keys
from fonolith.operators.words import valid_words
from fonolith.plans import payload
from fonolith.schema import END_PADDING_MS, LONG, MANY_WORDS, MAX_PHRASE_MS, MIN_PHRASE_MS, MIN_SEGMENT_MS, SILENCE_MS
from fonolith.sources import sinks
from fonolith.sources.transcripts import Recognizer, RecognizerOptions, Transcriber, audio_files, clip_listing, ensure_audio_input, read_transcripts, recordings_of, segments_of, transcribe, words_of
from fonolith.storage import materialize
from fonolith.workers import ready

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class VisemeOptions:
    model: str = "base"
    silence_cues: bool = True
    silence_threshold_ms: float = SILENCE_MS
    device: str = "auto"
    compute_type: str = "int8"
    beam_size: int = 1
    vad_filter: bool = True
    quarantine: str | None = None

    def recognizer(self) -> RecognizerOptions:
        return RecognizerOptions(self.model, "es", self.device, self.compute_type, self.beam_size, self.vad_filter)


@dataclass(frozen=True)
class DatasetOptions:
    sample_rate: int = 22_050
    metadata_format: str = "classic"
    min_duration_ms: int = MIN_SEGMENT_MS
    max_duration_ms: int | None = None
    end_padding_ms: int = END_PADDING_MS
    export: bool = True
    encoder: str = "ffmpeg"
    encoder_seconds: float = 3600.0
    quarantine: str | None = None


@dataclass(frozen=True)
class TranscriptOptions:
    model: str = "large-v3"
    language: str | None = None
    normalize_phrases: bool = True
    shortest_ms: int = MIN_PHRASE_MS
    longest_ms: int = MAX_PHRASE_MS
    quarantine: str | None = None

    def recognizer(self) -> RecognizerOptions:
        return RecognizerOptions(self.model, self.language)


def recognized(spark: SparkSession, audio: str, transcriber: Transcriber | Recognizer | None, options: RecognizerOptions, single: bool = True) -> DataFrame:
    """Transcript documents of an audio file, or with single=False of all supported files of a folder.

    They are written once: recognition is the most costly step, and the pipelines read its result several times.
    """
    ready(spark)
    if single:
        ensure_audio_input(spark, audio)
    return materialize(transcribe(audio_files(spark, audio), transcriber, options))


def recording_status(words: DataFrame) -> DataFrame:
    """(audio_id, status): whether a recording has valid words, and words that are left after normalization."""
    kept = valid_words(words).withColumn("norm", normalize_word(F.col("word"))).groupBy("audio_id").agg(F.count_if(F.col("norm") != "").alias("usable"))
    status = F.when(F.col("usable").isNull(), "no word timestamps").when(F.col("usable") == 0, "no usable words").otherwise("ok")
    return words.select("audio_id").distinct().join(kept, "audio_id", "left").select("audio_id", status.alias("status"))


@dataclass(frozen=True)
class _Visemes:
    """What the outputs of the viseme pipeline are made of."""

    files: DataFrame
    words: DataFrame
    segments: DataFrame
    shapes: DataFrame
    line: DataFrame


def _visemes(spark: SparkSession, source: str | DataFrame, options: VisemeOptions, single: bool) -> _Visemes:
    segments = segments_of(read_transcripts(spark, source, options.quarantine))
    raw = words_of(segments)
    if single and (bad := recording_status(raw).where("status <> 'ok'").first() or (raw.limit(1).count() == 0 and ("", "no word timestamps"))):
        raise PipelineError(f"{bad[1]}: nothing in this recording can be shown as mouth shapes")
    words = valid_words(raw, large_keys(raw, "audio_id", LONG))
    shapes = payload.shaped_words(words)
    line = payload.recording_timeline(shapes, options.silence_cues, max(0.0, options.silence_threshold_ms))
    return _Visemes(segments.select("audio_id", "audio_file", "language").distinct(), words, segments, shapes, line)


def viseme_payloads(spark: SparkSession, source: str | DataFrame, options: VisemeOptions = VisemeOptions(), single: bool = False) -> tuple[DataFrame, DataFrame]:
    """Main payloads and mouth cues of all recordings.

    Recordings without usable words give no payload; in single mode that is an error.
    """
    v = _visemes(spark, source, options, single)
    main = payload.main_payloads(v.files, v.words, v.segments, options.model, F.col("language"), shapes=v.shapes, line=v.line)
    return main, payload.mouth_cue_payloads(v.line)


def write_visemes(spark: SparkSession, source: str | DataFrame, output: str, mouth_cues: str | None = None, options: VisemeOptions = VisemeOptions(), single: bool = False) -> None:
    """Writes the payloads of viseme_payloads(), and with a path for them the mouth cues, as files in a folder, or single as that file.

    A recording's text is written in pieces, by several tasks if it is long, and never held as a whole.
    """
    v = _visemes(spark, source, options, single)
    sinks.write_pieces(payload.main_pieces(v.files, v.words, v.segments, options.model, F.col("language"), shapes=v.shapes, line=v.line), output, single)
    if mouth_cues:
        sinks.write_pieces(payload.mouth_cue_pieces(v.line), mouth_cues, single)


def transcript_payloads(spark: SparkSession, source: str | DataFrame, options: TranscriptOptions = TranscriptOptions()) -> DataFrame:
    """Transcript documents with phrases, from recognized segments, also of recordings without any."""
    documents = read_transcripts(spark, source, options.quarantine)
    segments = segments_of(documents)
    found = phrases.build_phrases(segments)
    if options.normalize_phrases:
        words = words_of(segments)
        long, many = large_keys(words, "audio_id", LONG), None
        if large_keys(words, "audio_id", MANY_WORDS).limit(1).count():
            found, many = materialize(found), MANY_WORDS
        found = phrases.normalize_phrases(found, options.shortest_ms, options.longest_ms, long, many)
    files = recordings_of(documents).select("audio_id", "audio_file").distinct()
    return payload.transcript_documents(files, segments, found, options.model, options.language, empty=True)


def build_dataset(spark: SparkSession, source: str | DataFrame, output: str, options: DatasetOptions = DatasetOptions()) -> DataFrame:
    """Writes the file output/metadata.csv and the clips in output/wavs, and returns a summary row for each recording.

    Clips are numbered on from those in output/wavs: segments are cut under provisional names first, and those that
    succeed are numbered and renamed; failures count as skipped.  Without export nothing is cut, and the metadata lists
    the clips that there would be.
    """
    ready(spark)
    documents = read_transcripts(spark, source, options.quarantine)
    if documents.where(F.coalesce("audio_file", F.lit("")) == "").limit(1).count():
        raise ValueError("a transcript names no audio_file")
    segments = segments_of(documents).withColumn("prefix", audio_prefix(F.col("audio_file")))
    checked = dataset.with_skip_reason(segments, options.min_duration_ms, options.max_duration_ms)
    wavs = sinks.clips_folder(spark, output)
    provisional = F.format_string(".%d_%d.wav", "audio_id", "seg")
    if options.export:
        sinks.check_export(documents, options.encoder)
        checked = materialize(checked)
        cuts = dataset.cut_list(checked.where("skip_reason is null"), options.end_padding_ms).withColumn("filename", provisional)
        # written once: the encoder doesn't run again for later steps
        done = materialize(sinks.export_clips(cuts, wavs, options.sample_rate, options.encoder, options.encoder_seconds))
        failed = done.where("not ok").select(F.col("filename").alias("cut"), F.lit(True).alias("failed"))
        checked = checked.withColumn("cut", provisional).join(failed, "cut", "left")
        checked = checked.withColumn("skip_reason", F.coalesce("skip_reason", F.when(F.col("failed"), F.lit("export failed")))).drop("failed", "cut")
    counted, seen = dataset.skip_counts(checked)
    checked = materialize(counted)
    LOG.info("segments: %s", {k: v for k, v in seen.get.items() if v})
    # the listing is read before any clip gets its name
    clips = materialize(dataset.clip_names(checked.where("skip_reason is null"), dataset.max_suffix(clip_listing(spark, wavs))))
    if options.export:
        named = sinks.rename_clips(clips.select(provisional.alias("old"), F.col("filename").alias("new")), wavs)
        if named < clips.count():
            raise PipelineError(f"only {named} clips are in {wavs}")
    sinks.write_metadata(dataset.metadata(clips, options.metadata_format), f"{output}/metadata.csv")
    summary = dataset.build_summary(checked, "audio_file", "prefix")
    return summary.select("total_segments", "exported_segments", "skipped_segments", F.lit(output).alias("output_dir"), F.lit(f"{output}/metadata.csv").alias("metadata_path"), F.col("prefix").alias("audio_prefix"), F.lit(options.sample_rate).alias("sample_rate"), "audio_file")
