"""python -m fonolith visemes|dataset|transcript|fetch: the pipelines from the command line.

Exit codes: 0 done, 1 the input can't be read, 2 the pipeline can't go on (or a dataset can't be built), 3 anything else.
"""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import os
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fonolith.errors import PipelineError
from fonolith.plans import pipelines
from fonolith.sources.files import local_path
from fonolith.sources.sinks import write_payload, write_payloads
from fonolith.sources.transcripts import FETCHED, fetch_audio, fetch_table, is_audio, read_transcripts


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fonolith")
    kinds = parser.add_subparsers(dest="kind", required=True)
    v = kinds.add_parser("visemes", help="audio or transcript JSON to viseme payloads")
    v.add_argument("--mouth-cues")
    v.add_argument("--model", default="base")
    v.add_argument("--device", default="auto")
    v.add_argument("--compute-type", default="int8")
    v.add_argument("--beam-size", type=int, default=1)
    v.add_argument("--no-vad-filter", action="store_true")
    v.add_argument("--silence-threshold", type=float, default=0.06)
    v.add_argument("--skip-silence-cues", action="store_true")
    d = kinds.add_parser("dataset", help="transcript JSON to a speech dataset")
    d.add_argument("--sample-rate", type=int, choices=(16_000, 22_050), default=22_050)
    d.add_argument("--format", "--metadata-format", choices=("classic", "piper"), default="classic")
    d.add_argument("--min-duration", type=float, default=0.4)
    d.add_argument("--max-duration", type=float)
    d.add_argument("--end-padding", type=float, default=0.25)
    d.add_argument("--trim-silence", action="store_true", help="taken and without effect")
    d.add_argument("--encoder", default="ffmpeg", help="the program that cuts clips, on the executors")
    d.add_argument("--encoder-seconds", type=float, default=3600.0, help="how long a call of it may take")
    d.add_argument("--no-export", action="store_true", help="only list the clips, cut none")
    t = kinds.add_parser("transcript", help="audio or recognized segments to transcript documents with phrases")
    t.add_argument("--model", default="large-v3")
    t.add_argument("--language")
    t.add_argument("--normalize-phrases", action=argparse.BooleanOptionalAction, default=True)
    f = kinds.add_parser("fetch", help="get audio from an address by a function of yours")
    f.add_argument("address", nargs="?")
    f.add_argument("--addresses", help="a text file with an address in each line, which are fetched side by side")
    f.add_argument("--output-dir", default="downloads")
    f.add_argument("--format", choices=FETCHED, default=FETCHED[0])
    f.add_argument("--fetcher", help="module:function")
    for p in (v, d, t):
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=p is not t, help="by default the input with the extension json" if p is t else None)
        p.add_argument("--quarantine", help="a file to list inputs in that are no transcripts; without it one is an error")
        p.add_argument("--verbose", action="store_true")
    for p in (v, t):
        p.add_argument("--recognizer", help="module:function, if the input is audio")
    return parser.parse_args(argv)


def _function(name: str | None) -> Callable | None:
    """What module:function names."""
    if not name:
        return None
    module, _, attribute = name.partition(":")
    try:
        return getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError, ValueError) as e:
        raise PipelineError(f"{name} can't be imported: {e}") from e


def _run(a: argparse.Namespace) -> None:
    if a.kind == "fetch" and a.addresses is None:
        if a.address is None:
            raise PipelineError("give an address, or --addresses")
        print(fetch_audio(a.address, a.output_dir, _function(a.fetcher), a.format))
        return
    spark = SparkSession.builder.appName("fonolith").getOrCreate()
    if a.kind == "fetch":
        fetcher = _function(a.fetcher)
        if fetcher is None:
            raise PipelineError("no fetcher is given: --fetcher module:function")
        got = fetch_table(spark.read.text(a.addresses).select(F.trim("value").alias("address")).where("address <> ''"), a.output_dir, fetcher, a.format)
        for row in got.toLocalIterator():
            print(row["path"] or f"{row['address']}: {row['message']}")
        if failed := got.where("path is null").count():
            raise PipelineError(f"{failed} addresses gave no audio")
        return
    ms = lambda seconds: round(seconds * 1000)
    if a.kind == "dataset":
        options = pipelines.DatasetOptions(a.sample_rate, a.format, ms(a.min_duration), None if a.max_duration is None else ms(a.max_duration), ms(a.end_padding), not a.no_export, a.encoder, a.encoder_seconds)
        documents = read_transcripts(spark, a.input, a.quarantine)
        try:
            for row in pipelines.build_dataset(spark, documents, a.output, options).toLocalIterator():
                print(json.dumps(row.asDict(), ensure_ascii=False))
        except Exception as e:
            raise PipelineError(f"no dataset: {e}") from e
        return
    if a.kind == "visemes":
        options = pipelines.VisemeOptions(a.model, not a.skip_silence_cues, max(0.0, a.silence_threshold * 1000), a.device, a.compute_type, a.beam_size, not a.no_vad_filter, quarantine=a.quarantine)
    else:
        options = pipelines.TranscriptOptions(a.model, a.language, a.normalize_phrases, quarantine=a.quarantine)
    source = pipelines.recognized(spark, a.input, _function(a.recognizer), options.recognizer()) if is_audio(a.input) else a.input
    if a.kind == "visemes":
        pipelines.write_visemes(spark, source, a.output, a.mouth_cues, options, single=True)
    else:
        output = a.output or f"{a.input.rpartition('.')[0]}.json"
        if output == a.input:
            raise PipelineError("the output is the input: give --output")
        # one input gives one file, a folder or pattern of them a folder
        single = is_audio(a.input) or (os.path.isfile(local_path(a.input)) if "://" not in a.input else a.input.endswith(".json"))
        (write_payload if single else write_payloads)(pipelines.transcript_payloads(spark, source, options), output)


def main(argv: list[str]) -> int:
    a = arguments(argv)
    if getattr(a, "verbose", False):
        logging.basicConfig(level=logging.DEBUG)
    try:
        _run(a)
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 1
    except (PipelineError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    except Exception as e:  # noqa: BLE001
        print(f"Unexpected: {e}", file=sys.stderr)
        return 3
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
