"""The nested outputs: main payload, mouth cues and transcript document, one JSON text for each recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fonolith.functions.text import language_or_default, seconds, strip
from fonolith.operators.scans import dealt, large_keys
from fonolith.operators.spans import timeline, word_spans
from fonolith.operators.words import spans_of, transcripts, with_visemes
from fonolith.schema import DECIMALS, GENERATOR, LONG, SILENCE_MS, TASK_WORDS, VISEMES
from fonolith.storage import materialize

_SPAN = "array<struct<viseme string, start double, end double>>"
MAIN_SCHEMA = (
    "metadata struct<generator string, timestamp_precision_decimals int, viseme_inventory array<string>, model string>, audio_file string, "
    f"language string, transcript string, words array<struct<word string, start double, end double, visemes {_SPAN}>>, timeline {_SPAN}"
)


def _span(s: Column, name: str = "viseme") -> Column:
    return F.struct(s["viseme"].alias(name), seconds(s["start_ms"]).alias("start"), seconds(s["end_ms"]).alias("end"))


def _in_order(*fields: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(*fields)))


def as_json(payload: Column) -> Column:
    return F.to_json(payload, {"ignoreNullFields": "false", "pretty": "true"})


def shaped_words(words: DataFrame) -> DataFrame:
    """with_visemes() of words, written once: words and timeline both come from it."""
    return materialize(with_visemes(words))


def recording_timeline(shapes: DataFrame, silence: bool = True, threshold: float = SILENCE_MS) -> DataFrame:
    """The timeline of each recording of with_visemes(), written once; of recordings of very many words in parts."""
    # words are dealt, not their many spans
    spans = spans_of(dealt(shapes, "audio_id", F.lit(1), TASK_WORDS))
    return materialize(timeline(spans, silence, threshold, large_keys(shapes, "audio_id", LONG)))


def _head(model: str) -> Column:
    return F.struct(F.lit(GENERATOR).alias("generator"), F.lit(DECIMALS).alias("timestamp_precision_decimals"), F.array(*map(F.lit, VISEMES)).alias("viseme_inventory"), F.lit(model).alias("model")).alias("metadata")


def _language(language: Column | None) -> Column:
    return language_or_default(F.lit(None).cast("string") if language is None else language).alias("language")


def _word() -> Column:
    """The word of a row of with_visemes() with its spans."""
    spans = F.transform(word_spans(F.col("start_ms"), F.col("end_ms"), F.col("codes")), lambda s: _span(s))
    return F.struct(F.col("norm").alias("word"), seconds(F.col("start_ms")).alias("start"), seconds(F.col("end_ms")).alias("end"), spans.alias("visemes"))


def main_payloads(files: DataFrame, words: DataFrame, segments: DataFrame, model: str, language: Column | None = None, *, shapes: DataFrame | None = None, line: DataFrame | None = None) -> DataFrame:
    """(audio_id, payload): metadata, file, language, transcript, words with their own spans, and the timeline.

    shapes and line: see shaped_words() and recording_timeline().
    """
    shapes = shaped_words(words) if shapes is None else shapes
    line = recording_timeline(shapes) if line is None else line
    spoken = shapes.select("audio_id", "word_idx", _word().alias("w"))
    by_word = spoken.groupBy("audio_id").agg(F.transform(_in_order("word_idx", "w"), lambda x: x["w"]).alias("words"))
    by_line = line.groupBy("audio_id").agg(F.transform(_in_order("seq", "viseme", "start_ms", "end_ms"), lambda s: _span(s)).alias("timeline"))
    joined = files.join(by_word, "audio_id").join(by_line, "audio_id").join(transcripts(segments, words), "audio_id", "left")
    body = F.struct(_head(model), "audio_file", _language(language), strip(F.coalesce("transcript", F.lit(""))).alias("transcript"), "words", "timeline")
    return joined.select("audio_id", as_json(body).alias("payload"))


def _element(value: Column, first: Column, deep: int = 1) -> Column:
    """An element of an array in a text of as_json(), at so many levels, with what separates it from the one before."""
    return F.concat(F.when(first, "").otherwise(", "), F.replace(as_json(value), F.lit("\n"), F.lit("\n" + "  " * deep)))


def _pieces(rows: DataFrame, part: int, idx: Column, text: Column) -> DataFrame:
    return rows.select("audio_id", F.lit(part).alias("part"), idx.cast("long").alias("idx"), text.alias("text"))


def main_pieces(files: DataFrame, words: DataFrame, segments: DataFrame, model: str, language: Column | None = None, *, shapes: DataFrame, line: DataFrame) -> DataFrame:
    """(audio_id, part, idx, text): the texts of main_payloads() in pieces, a word or a span each, so that no row has all of a recording's.

    The pieces of a recording make up its text in the order of part and idx.
    """
    first = shapes.groupBy("audio_id").agg(F.min("word_idx").alias("first"))
    there = files.join(first, "audio_id").join(line.select("audio_id").distinct(), "audio_id")
    head = F.struct(_head(model), "audio_file", _language(language), strip(F.coalesce("transcript", F.lit(""))).alias("transcript"))
    text = as_json(head)
    heads = there.join(transcripts(segments, words), "audio_id", "left")
    begin = F.concat(F.left(text, F.length(text) - 2), F.lit(',\n  "words" : [ '))
    spoken = shapes.join(there.select("audio_id", "first"), "audio_id")
    pieces = _pieces(heads, 0, F.lit(0), begin)
    pieces = pieces.unionByName(_pieces(spoken, 1, F.col("word_idx"), _element(_word(), F.col("word_idx") == F.col("first"))))
    pieces = pieces.unionByName(_pieces(there, 2, F.lit(0), F.lit(' ],\n  "timeline" : [ ')))
    spans = line.join(there.select("audio_id"), "audio_id", "left_semi")
    pieces = pieces.unionByName(_pieces(spans, 3, F.col("seq"), _element(_span(F.struct("viseme", "start_ms", "end_ms")), F.col("seq") == 0)))
    return pieces.unionByName(_pieces(there, 4, F.lit(0), F.lit(" ]\n}")))


def mouth_cue_pieces(line: DataFrame) -> DataFrame:
    """(audio_id, part, idx, text): the texts of mouth_cue_payloads() in pieces, as in main_pieces()."""
    there = line.select("audio_id").distinct()
    cues = _pieces(line, 1, F.col("seq"), _element(_span(F.struct("viseme", "start_ms", "end_ms"), "value"), F.col("seq") == 0))
    return _pieces(there, 0, F.lit(0), F.lit('{\n  "mouthCues" : [ ')).unionByName(cues).unionByName(_pieces(there, 2, F.lit(0), F.lit(" ]\n}")))


def mouth_cue_payloads(line: DataFrame) -> DataFrame:
    """(audio_id, payload) of a timeline: the cues under mouthCues, a cue's shape as its value."""
    cues = F.transform(_in_order("seq", "viseme", "start_ms", "end_ms"), lambda s: _span(s, "value"))
    return line.groupBy("audio_id").agg(as_json(F.struct(cues.alias("mouthCues"))).alias("payload"))


def transcript_documents(files: DataFrame, segments: DataFrame, phrases: DataFrame, model: str, language: str | None = None, empty: bool = False) -> DataFrame:
    """(audio_id, payload): the document that the dataset pipeline reads; words keep their probability where they have one.

    empty: files without segments have a document too.
    """
    more = ["probability"] if "probability" in segments.schema["words"].dataType.elementType.names else []
    words = F.transform("words", lambda w: F.struct(w["word"].alias("word"), seconds(w["start_ms"]).alias("start"), seconds(w["end_ms"]).alias("end"), *(w[c].alias(c) for c in more)))
    shape = lambda df, place: df.select("audio_id", F.col(place).alias("place"), F.struct(*([F.col(place).alias("id")] if place == "seg" else []), seconds(F.col("start_ms")).alias("start"), seconds(F.col("end_ms")).alias("end"), strip(F.coalesce("text", F.lit(""))).alias("text"), words.alias("words")).alias("x"))
    gather = lambda df, place, name: shape(df, place).groupBy("audio_id").agg(F.transform(_in_order("place", "x"), lambda v: v["x"]).alias(name))
    s, p = gather(segments, "seg", "segments"), gather(phrases, "phrase_idx", "phrases")
    whole = lambda df, name: F.coalesce(name, F.array().cast(df.schema[name].dataType)).alias(name)
    text = F.array_join(F.filter(F.transform(whole(s, "segments"), lambda x: x["text"]), lambda t: t != ""), " ")
    joined = files.join(s, "audio_id", "left" if empty else "inner").join(p, "audio_id", "left")
    return joined.select("audio_id", as_json(F.struct("audio_file", F.lit(model).alias("model"), F.lit(language).alias("language"), text.alias("text"), whole(s, "segments"), whole(p, "phrases"))).alias("payload"))
