"""Files that other programs open: written by many tasks side by side, and put in place at once.

A file comes in pieces of text with an order.  Running sums of their sizes say where each piece begins, so every task writes
its own pieces of a file at their places, and neither a file nor all files of an output meet in one task.  What is written is
put in place when all tasks are done: by one renaming, so that a reader finds the old output or the new one.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from fonolith.errors import PipelineError
from fonolith.operators.scans import running
from fonolith.workers import ready

#: Bytes that a task holds before it writes them.
_HELD = 1 << 20


def local_path(path: str) -> str:
    """The path without the scheme file:, as programs other than Spark take it; other schemes raise PipelineError."""
    if path.startswith("file:"):
        path = path.removeprefix("file:")
        return "/" + path.lstrip("/")
    if "://" in path:
        raise PipelineError(f"{path} is no path of a file system that all machines have mounted, which programs other than Spark need")
    return path


@dataclass
class Written(WriterCommitMessage):
    """How many bytes a task wrote."""

    bytes: int


class PieceWriter(DataSourceArrowWriter):
    """Writes (file, offset, text) to files of a new folder, which goes if that fails."""

    def __init__(self, staging: str) -> None:
        self.staging = staging

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Neighbouring pieces go out together.  A task that runs again writes the same bytes at the same places."""
        name, at, held, total = None, 0, [], 0

        def flush() -> None:
            if held:
                fd = os.open(os.path.join(self.staging, name), os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    data = memoryview(b"".join(held))
                    done = 0
                    while done < len(data):
                        done += os.pwrite(fd, data[done:], at + done)
                finally:
                    os.close(fd)
                held.clear()

        for batch in iterator:
            for file, offset, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if "/" in file or file in ("", ".", ".."):
                    raise ValueError(f"{file!r} is no name of a file")
                size = sum(map(len, held))
                if file != name or offset != at + size or size >= _HELD:
                    flush()
                    name, at = file, offset
                data = text.encode()
                held.append(data)
                total += len(data)
        flush()
        return Written(total)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class FilePieces(DataSource):
    """The sink of write_files()."""

    @classmethod
    def name(cls) -> str:
        return "fonolith_file_pieces"

    def writer(self, schema, overwrite: bool) -> PieceWriter:  # noqa: ANN001
        return PieceWriter(self.options["staging"])


def _put(staging: str, target: str, single: bool, empty: bool) -> None:
    """Puts the folder `staging`, or its only file, in place of target."""
    found, old = staging, f"{staging}-old"
    if single:
        names = os.listdir(staging)
        if not names and empty:
            names = ["empty"]
            open(os.path.join(staging, names[0]), "w").close()
        if len(names) != 1:
            shutil.rmtree(staging)
            raise PipelineError(f"{target} is to be one file, but there are {len(names)}")
        found = os.path.join(staging, names[0])
    if os.path.lexists(target) and not (single and os.path.isfile(target)):
        os.rename(target, old)
    os.replace(found, target)
    for rest in (staging, old):
        if rest != target:
            shutil.rmtree(rest, ignore_errors=True)


def write_files(pieces: DataFrame, file: Column, text: Column, target: str, order: list[Column] | None = None, single: bool = False, empty: bool = False) -> None:
    """Writes the texts of pieces to the files that they name, in a folder `target` that takes the place of what was there.

    order: of the pieces of a file (it must be total); without it each piece is a file.  single: all pieces are of one file, and
    target is that file; no pieces are an error then, or with `empty` an empty file.  A null text is an empty one.  The path must be one that all machines have mounted.
    """
    spark, target = pieces.sparkSession, local_path(target).rstrip("/")
    ready(spark)
    rows = pieces.withColumn("fr_file", file).withColumn("fr_text", F.coalesce(text, F.lit("")))
    offset = F.lit(0).cast("long")
    if order is not None:
        rows = running(rows, "fr_file", order, before=True, fr_offset=("sum", F.octet_length("fr_text").cast("long")))
        offset = F.coalesce("fr_offset", offset)
    folder, base = os.path.split(os.path.abspath(target))
    staging = os.path.join(folder, f".{base}-{uuid.uuid4().hex}")
    os.makedirs(staging)
    spark.dataSource.register(FilePieces)
    rows.select(F.col("fr_file").alias("file"), offset.alias("offset"), F.col("fr_text").alias("text")).write.format(FilePieces.name()).option("staging", staging).mode("append").save()
    _put(staging, os.path.abspath(target), single, empty)
