"""Stands in for a recognizer and a fetcher: audio files hold their own transcripts."""

import json
import os
import pathlib

import pandas as pd

from fonolith.sources.transcripts import Recognizer


def from_json(batches, options):
    for batch in batches:
        rows = [json.loads(c) for c in batch["content"]]
        yield pd.DataFrame({"path": batch["path"], "language": [r.get("language") for r in rows], "text": [f" beam {options.beam_size} " for _ in rows], "segments": [[dict(s, words=[{"text": None, "probability": None, **w} for w in s["words"]]) for s in r["segments"]] for r in rows]})


def opening(options):
    """Notes each loading in the file that the model's name is."""
    with open(options.model, "a") as f:
        f.write(f"{os.getpid()}\n")
    return lambda batches: from_json(batches, options)


LOADED = Recognizer(opening)


def fetch(address, folder, form):
    if "lost" in address:
        raise OSError("no such talk")
    if "/" in address and address.rpartition("/")[2].isdigit():
        name = address.rpartition("/")[2]
        (pathlib.Path(folder) / f"{name}.{form}").write_text(address)
        return f"{name}.webm"
    (pathlib.Path(folder) / f"talk.{form}").write_text(address)
    return f"{folder}/talk.webm"
