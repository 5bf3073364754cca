"""Structured Streaming over arriving transcript files: each micro-batch runs the batch engine. A transcript is one file, so no state crosses batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptmill.plans.engine import analyze
from scriptmill.sources.glossary import Glossary
from scriptmill.sources.transcripts import parse_transcripts


def watch(spark: SparkSession, folder: str, sink: Callable[[DataFrame, int], None], checkpoint: str, glossary: Glossary | None = None, files_per_batch: int = 100, once: bool = False) -> StreamingQuery:
    """Analyse files as they arrive; ``sink(findings, batch)`` gets each batch's findings and must be idempotent per batch number."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).load(folder).select(F.col("_metadata.file_path").alias("transcript_id"), F.col("value").alias("json"))

    def batch(df: DataFrame, number: int) -> None:
        transcripts, segments = parse_transcripts(df)
        sink(analyze(transcripts.filter("error IS NULL"), segments, glossary).findings, number)

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
