"""Following a folder of transcript documents as a stream.

A document holds a whole recording, so each micro-batch is complete in itself: the batch pipelines run over its new
documents, and no state is kept between batches but the counts of segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fonolith.operators.dataset import with_skip_reason
from fonolith.plans.pipelines import VisemeOptions, viseme_payloads
from fonolith.schema import TRANSCRIPT
from fonolith.sources.transcripts import segments_of


def read_transcript_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New JSON documents of a folder as a stream under the declared schema."""
    return spark.readStream.schema(TRANSCRIPT).option("multiLine", True).json(folder).select("*", F.col("_metadata.file_path").alias("document"))


def follow_visemes(spark: SparkSession, folder: str, output: str, checkpoint: str, options: VisemeOptions = VisemeOptions(), **trigger) -> StreamingQuery:
    """Writes the main payloads of new documents to output, one folder for each batch; a batch that is repeated overwrites its own.

    trigger: as for writeStream.trigger; by default all that is there now.
    """

    def each(batch: DataFrame, number: int) -> None:
        main, _ = viseme_payloads(spark, batch, options)
        main.write.mode("overwrite").parquet(f"{output}/batch={number}")

    stream = read_transcript_stream(spark, folder)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def segment_counts(stream: DataFrame) -> DataFrame:
    """Running counts of segments by the reason they would be skipped for (null: exported); for output mode complete."""
    return with_skip_reason(segments_of(stream)).groupBy("skip_reason").agg(F.count("*").alias("segments"))
