"""Reading transcript documents, audio files and existing clips.

Speech recognition and downloads are given as functions: a Transcriber gets audio files and options, a Fetcher an address.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.errors import PipelineError
from fonolith.functions.text import first_filled, strip
from fonolith.schema import AUDIO_EXTENSIONS, SEGMENT, TRANSCRIPT
from fonolith.sources.files import local_path, write_files
from fonolith.storage import materialize
from fonolith.workers import ready

#: Why a file is no document.
EMPTY, NO_JSON, NO_FIELDS = "nothing in it", "no JSON", "no field of a transcript"


@dataclass(frozen=True)
class RecognizerOptions:
    """What a recognizer is asked for; language None: it finds out."""

    model: str = "large-v3"
    language: str | None = None
    device: str = "auto"
    compute_type: str = "auto"
    beam_size: int = 5
    vad_filter: bool = False
    temperature: float = 0.0
    word_timestamps: bool = True
    condition_on_previous_text: bool = True


#: Takes batches of (path, content) of audio files and the options, and gives (path, language, text, segments) for each.
Transcriber = Callable[[Iterator[pd.DataFrame], RecognizerOptions], Iterator[pd.DataFrame]]


@dataclass(frozen=True)
class Recognizer:
    """A recognizer whose model each Python worker loads once, and keeps for all tasks that it runs.

    load: takes the options and gives a function like a Transcriber that takes batches only.  profile: what executors and tasks of
    the stage need, devices for instance (see pyspark.resource).
    """

    load: Callable[[RecognizerOptions], Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]]
    profile: ResourceProfile | None = None


#: The recognizers that this process has loaded.
_LOADED: dict = {}


def loaded(load: Callable, options: RecognizerOptions) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """load(options), made once in this process."""
    name = (load.__module__, load.__qualname__, options)
    if name not in _LOADED:
        _LOADED[name] = load(options)
    return _LOADED[name]


#: Takes an address, a folder and an audio format, puts the audio there and gives the name of the file it began with.
Fetcher = Callable[[str, str, str], str]
#: The formats to fetch audio in, the first one by default (fixed values).
FETCHED = ("mp3", "m4a", "wav", "opus", "flac")


def _judged(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The JSON files that path names under the declared schema, with document and reason (see read_documents()), and the names of all files."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no transcript at {path}")
    bad = "fr_corrupt"
    parsed = spark.read.schema(f"{TRANSCRIPT}, {bad} string").option("multiLine", True).option("columnNameOfCorruptRecord", bad).json(path)
    names = [c for c in parsed.columns if c != bad]
    hollow = F.coalesce(*(F.when(F.col(c).isNotNull(), 1) for c in names)).isNull()
    reason = F.when(hollow, F.when(F.col(bad).isNotNull(), F.lit(NO_JSON)).otherwise(F.lit(NO_FIELDS)))
    return parsed.select(*names, F.col("_metadata.file_path").alias("document"), reason.alias("reason")), parsed.inputFiles()


def _rejected(rows: DataFrame, names: list[str]) -> DataFrame:
    """(document, reason) of judged rows, and of the files that gave none."""
    # a file that holds nothing gives no row; the driver, which lists all files to read them, knows of it
    if len(names) == rows.select("document").distinct().count():
        names = []
    listed = rows.sparkSession.createDataFrame([(n,) for n in names], "document string")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    empty = listed.join(rows.select(plain("document").alias("at")), plain("document") == F.col("at"), "left_anti").select("document", F.lit(EMPTY).alias("reason"))
    return rows.where("reason is not null").select("document", "reason").unionByName(empty).withColumn("document", plain("document"))


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, rejected) of the JSON files that path names: all that are a document, and (document, reason) of all others.

    Documents are under the declared schema, with the path of each in the column document, parsed once and written.  A value that
    doesn't fit its type becomes null, and the rest of its document stays.  A file is rejected if nothing is in it, if it isn't
    JSON, or if what it holds has none of a document's fields.
    """
    judged, names = _judged(spark, path)
    rows = materialize(judged)
    return rows.where("reason is null").drop("reason"), _rejected(rows, names)


def rejected_documents(spark: SparkSession, path: str) -> DataFrame:
    """The second part of read_documents() alone: of the documents only names are written."""
    judged, names = _judged(spark, path)
    return _rejected(materialize(judged.select("document", "reason")), names)


def read_transcripts(spark: SparkSession, source: str | DataFrame, quarantine: str | None = None) -> DataFrame:
    """Transcript documents: JSON files (see read_documents()), or a DataFrame that is passed through.

    Files that are no documents raise PipelineError; with quarantine, they are listed in that file instead, a line of JSON
    (document, reason) for each.
    """
    if isinstance(source, DataFrame):
        return source
    documents, rejected = read_documents(spark, source)
    if quarantine is None:
        first = rejected.orderBy("document").first()
        if first:
            raise PipelineError(f"{first['document']} is no transcript: {first['reason']}")
    else:
        line = F.concat(F.to_json(F.struct("document", "reason")), F.lit("\n"))
        write_files(rejected.withColumn("line", line), F.lit("rejected"), F.col("line"), quarantine, order=[F.col("document")], single=True, empty=True)
    return documents


def _millis(seconds: Column) -> Column:
    return F.round(seconds * 1000).cast("bigint")


def recordings_of(documents: DataFrame, *more: Column) -> DataFrame:
    """(audio_id, audio_file, language) and more columns of transcript documents: each is a recording of its own.

    That holds also where another one names the same audio file or none: audio_id is the hash of all columns, with the path
    of a document's JSON where it has one (column document).
    """
    language = F.col("language") if "language" in documents.columns else F.lit(None).cast("string")
    return documents.select(F.xxhash64(*(F.col(f"`{c}`") for c in documents.columns)).alias("audio_id"), "audio_file", language.alias("language"), *more)


def segments_of(documents: DataFrame) -> DataFrame:
    """(audio_id, audio_file, language, seg, text, start_ms, end_ms, words) of transcript documents; seg is the place in the document."""
    words = lambda w: F.transform(F.coalesce(w, F.array().cast(f"array<{SEGMENT.split('words array<')[1][:-2]}>")), lambda x: F.struct(first_filled(x["word"], x["text"]).alias("word"), _millis(x["start"]).alias("start_ms"), _millis(x["end"]).alias("end_ms"), x["probability"].alias("probability")))
    rows = recordings_of(documents, F.posexplode("segments").alias("seg", "s"))
    return rows.select("audio_id", "audio_file", "language", "seg", F.col("s.text").alias("text"), _millis(F.col("s.start")).alias("start_ms"), _millis(F.col("s.end")).alias("end_ms"), words(F.col("s.words")).alias("words"))


def words_of(segments: DataFrame) -> DataFrame:
    """(audio_id, word_idx, word, start_ms, end_ms) of segments, in document order."""
    rows = segments.select("audio_id", "seg", F.posexplode("words").alias("wi", "w"))
    return rows.select("audio_id", (F.col("seg").cast("bigint") * 2**31 + F.col("wi")).alias("word_idx"), "w.word", "w.start_ms", "w.end_ms")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def ensure_audio_input(spark: SparkSession, path: str) -> None:
    """Raises unless path is an existing file with a supported extension."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no audio at {path}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        raise PipelineError(f"{path} is a folder; the audio of one recording is expected")
    if not is_audio(path):
        raise PipelineError(f"{path} has none of the extensions {', '.join(sorted(AUDIO_EXTENSIONS))}")


def is_audio(path: str) -> bool:
    """Whether the last part of the path has a supported extension."""
    name = path.rstrip("/").rpartition("/")[2]
    return "." in name[1:] and f".{name.rpartition('.')[2]}".lower() in AUDIO_EXTENSIONS


def supported_audio(paths: DataFrame, path: str = "path") -> DataFrame:
    """The rows whose path has a supported extension."""
    return paths.where(F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)).isin(*AUDIO_EXTENSIONS))


def audio_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of the supported audio files in a folder."""
    return supported_audio(spark.read.format("binaryFile").load(folder)).select("path", "content")


def transcribe(audio: DataFrame, transcriber: Transcriber | Recognizer | None, options: RecognizerOptions = RecognizerOptions()) -> DataFrame:
    """Transcript documents from audio files by the given recognizer; without one this raises."""
    if transcriber is None:
        raise PipelineError("no recognizer is given: pass a function from batches of (path, content) and options to (path, language, text, segments)")
    schema = f"path string, language string, text string, segments array<{SEGMENT}>"
    if isinstance(transcriber, Recognizer):
        load = transcriber.load
        found = audio.mapInPandas(lambda batches: loaded(load, options)(batches), schema, profile=transcriber.profile)
    else:
        found = audio.mapInPandas(lambda batches: transcriber(batches, options), schema)
    return found.select(F.col("path").alias("audio_file"), F.lit(options.model).alias("model"), F.coalesce("language", F.lit(options.language)).alias("language"), strip(F.coalesce("text", F.lit(""))).alias("text"), "segments")


def fetch_audio(address: str, folder: str, fetcher: Fetcher | None, form: str = FETCHED[0]) -> str:
    """The path of the audio that the given function fetches into folder (made if needed), with the format as extension."""
    if form not in FETCHED:
        raise ValueError(f"{form} is none of the formats {', '.join(FETCHED)}")
    if fetcher is None:
        raise PipelineError("no fetcher is given: pass a function from (address, folder, format) to the name of the file it got")
    os.makedirs(folder, exist_ok=True)
    name = os.path.basename(fetcher(address, folder, form))
    return f"{folder.rstrip('/')}/{os.path.splitext(name)[0]}.{form}"


def fetch_table(addresses: DataFrame, folder: str, fetcher: Fetcher | None, form: str = FETCHED[0]) -> DataFrame:
    """(address, path, message) of a table (address): where each one's audio is, or why there is none.

    Each address is fetched once, on the executors, a task for each up to the parallelism of a shuffle times 16, so a slow one
    holds up few others.  The result is written, so that nothing is fetched again for later steps; a task that is lost fetches
    its addresses again.  The folder must be one that all machines have mounted.
    """
    if form not in FETCHED:
        raise ValueError(f"{form} is none of the formats {', '.join(FETCHED)}")
    ready(addresses.sparkSession)
    at = local_path(folder)

    def body(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for address in batch["address"]:
                try:
                    rows.append((address, fetch_audio(address, at, fetcher, form), None))
                except Exception as e:  # noqa: BLE001  one address must not end the others
                    rows.append((address, None, str(e)[-500:] or type(e).__name__))
            yield pd.DataFrame(rows, columns=["address", "path", "message"])

    tasks = 16 * int(addresses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = addresses.select("address").where("address is not null").distinct()
    return materialize(wanted.repartition(tasks, "address").mapInPandas(body, "address string, path string, message string"))


def clip_listing(spark: SparkSession, folder: str) -> DataFrame:
    """(prefix, name, is_file) of the files in a folder of clips; prefix is what stands before the last underscore."""
    if not _exists(spark, folder):
        return spark.createDataFrame([], "prefix string, name string, is_file boolean")
    names = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    return names.select(F.regexp_extract("name", r"^(.*)_[^_]*$", 1).alias("prefix"), "name", F.lit(True).alias("is_file"))
