"""Writing payloads, metadata and clips."""

from __future__ import annotations

import os
import shutil
import subprocess
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.errors import PipelineError
from fonolith.sources.files import local_path, write_files

#: A recording is cut in stretches of so many milliseconds, by calls of the encoder that write so many clips at most.
STRETCH_MS, CLIPS = 600_000, 64


def write_payloads(payloads: DataFrame, folder: str) -> None:
    """One JSON file for each recording: folder/<audio_id>.json; takes the place of what was there."""
    write_files(payloads, F.concat(F.col("audio_id").cast("string"), F.lit(".json")), F.col("payload"), folder)


def write_payload(payloads: DataFrame, path: str) -> None:
    """The payload of one recording as the file that path names; more than one, or none, is an error."""
    write_files(payloads, F.concat(F.col("audio_id").cast("string"), F.lit(".json")), F.col("payload"), path, single=True)


def write_pieces(pieces: DataFrame, path: str, single: bool = False) -> None:
    """The texts that pieces (audio_id, part, idx, text) make up, as write_payloads() or write_payload() would write them."""
    write_files(pieces, F.concat(F.col("audio_id").cast("string"), F.lit(".json")), F.col("text"), path, order=[F.col("part"), F.col("idx")], single=single)


def csv_line(*fields: Column) -> Column:
    """Fields between |, null as empty, quoted only where needed, with the end of the line."""
    field = lambda c: F.when(c.rlike('[|"\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    texts = [field(F.coalesce(c, F.lit(""))) for c in fields]
    return F.concat(*[x for t in texts for x in (F.lit("|"), t)][1:], F.lit("\n"))


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One file of lines without a header, in the order of file names; takes the place of what was there."""
    write_files(metadata, F.lit("metadata.csv"), csv_line(*(F.col(c) for c in metadata.columns)), path, order=[F.col("filename")], single=True, empty=True)


def clips_folder(spark: SparkSession, output: str) -> str:
    """output/wavs, made if it isn't there; its path must be one that all machines have mounted."""
    folder = f"{local_path(output).rstrip('/')}/wavs"
    os.makedirs(folder, exist_ok=True)
    return folder


def check_export(files: DataFrame, encoder: str = "ffmpeg") -> None:
    """Raises unless each audio_file of files, and the encoder, is found where clips are cut: on the executors."""

    def body(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad = [not_found(f) for f in batch["audio_file"]]
            yield pd.DataFrame({"bad": bad, "encoder": shutil.which(encoder) is not None}).astype({"bad": object, "encoder": bool})

    def not_found(file: str) -> str | None:
        try:
            return None if os.path.isfile(local_path(file)) else f"no audio at {file}"
        except PipelineError as e:
            return f"audio can't be cut: {e}"

    bad = files.select("audio_file").distinct().mapInPandas(body, "bad string, encoder boolean").where("bad is not null or not encoder").first()
    if bad and bad["bad"]:
        raise (FileNotFoundError if bad["bad"].startswith("no audio") else PipelineError)(bad["bad"])
    if bad:
        raise PipelineError(f"clips can't be cut: the executors find no program {encoder}")


def _cut(encoder: str, audio: str, begin: int, cuts: list[tuple[str, int, int]], sample_rate: int, limit: float) -> tuple[set[int], str]:
    """Calls the encoder once for cuts (path, start, length) of a recording, read from `begin` on; which of them are there, and what it says.

    Clips are written beside their paths and then renamed, so a file with such a path is whole.
    """
    mark = uuid.uuid4().hex
    parts = [os.path.join(os.path.dirname(path), f".{mark}-{k}.wav") for k, (path, _, _) in enumerate(cuts)]
    second = lambda ms: f"{ms / 1000:.3f}"
    # decoding begins where the first cut does, unless that is in the first stretch
    call = [encoder, "-hide_banner", "-loglevel", "error", "-y", *(["-ss", second(begin)] if begin else []), "-i", audio]
    for part, (_, start, length) in zip(parts, cuts, strict=True):
        call += ["-ss", second(start - begin), "-t", second(length), "-ar", str(sample_rate), "-ac", "1", "-sample_fmt", "s16", part]
    try:
        done = subprocess.run(call, capture_output=True, text=True, timeout=limit, stdin=subprocess.DEVNULL)
        message, ok = done.stderr[-500:], done.returncode == 0
    except subprocess.TimeoutExpired:
        message, ok = f"stopped after {limit:g} seconds", False
    except OSError as e:
        message, ok = str(e), False
    there = set()
    for k, (part, (path, _, _)) in enumerate(zip(parts, cuts, strict=True)):
        if ok and os.path.isfile(part):
            os.replace(part, path)
            there.add(k)
        elif os.path.exists(part):
            os.remove(part)
    return there, message


def export_clips(cuts: DataFrame, folder: str, sample_rate: int = 22_050, encoder: str = "ffmpeg", limit: float = 3600.0) -> DataFrame:
    """(filename, ok, message): cuts (audio_file, filename, cut_start_ms, cut_ms) as mono 16-bit WAV by the encoder on the executors.

    A recording is decoded once: one call writes all its clips, or, of a long one, those of a stretch, and stretches are cut in
    different tasks.  If a call fails, or takes more than `limit` seconds, its clips are cut one by one, so that a bad one fails
    alone.  Folder and audio files must be where all executors reach them.  A task that runs again writes the same files again.
    """

    def body(group: pd.DataFrame) -> pd.DataFrame:
        group, rows = group.sort_values(["cut_start_ms", "filename"], kind="stable"), []
        audio = local_path(group["audio_file"].iloc[0])
        for a in range(0, len(group), CLIPS):
            part = group.iloc[a : a + CLIPS]
            clips = [(f"{folder}/{n}", int(s), int(m)) for n, s, m in zip(part["filename"], part["cut_start_ms"], part["cut_ms"], strict=True)]
            from_start = a == 0 and int(group["stretch"].iloc[0]) == 0
            there, message = _cut(encoder, audio, 0 if from_start else max(0, clips[0][1]), clips, sample_rate, limit)
            said = [message] * len(clips)
            for k in sorted(set(range(len(clips))) - there) if len(clips) > 1 else []:
                alone, said[k] = _cut(encoder, audio, 0 if from_start else max(0, clips[k][1]), [clips[k]], sample_rate, limit)
                if alone:
                    there.add(k)
            rows += [(n, k in there, "" if k in there else said[k] or "the encoder wrote no clip") for k, n in enumerate(part["filename"])]
        return pd.DataFrame(rows, columns=["filename", "ok", "message"])

    rows = cuts.select("audio_file", "filename", "cut_start_ms", "cut_ms").withColumn("stretch", F.expr(f"greatest(cut_start_ms, 0) div {STRETCH_MS}"))
    return rows.groupBy("audio_file", "stretch").applyInPandas(body, "filename string, ok boolean, message string")


def rename_clips(names: DataFrame, folder: str) -> int:
    """Gives the files `old` of folder the names `new`, on the executors; returns how many there are now.

    A task that runs again finds its files renamed already.
    """

    def body(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = local_path(folder)
        for batch in batches:
            for old, new in zip(batch["old"], batch["new"], strict=True):
                if os.path.exists(f"{at}/{old}"):
                    os.replace(f"{at}/{old}", f"{at}/{new}")
            yield pd.DataFrame({"there": batch["new"].map(lambda n: os.path.exists(f"{at}/{n}"))}).astype(bool)

    return names.select("old", "new").mapInPandas(body, "there boolean").where("there").count()
