"""Incremental ingest: new feed files → landing table, each batch once.

In-day files keep arriving; each run picks up only files it has not seen
(the file source's checkpoint remembers them), parses them with the batch
parser and appends to ``landing/partition=...``.  ``availableNow`` processes
what is there and stops, so the same code serves a scheduled batch and a
continuous stream (``processing_time``).

Corrections are *not* resolved here: the end-of-day ``clean`` step keeps the
latest version per key.  (A streaming ``dropDuplicatesWithinWatermark`` would
keep the first version, which is the wrong one.)
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import COMMON_EVENT_COLUMNS
from ..sources.ingest import parse_csv_lines, parse_json_lines
from ..sources.store import write_landing


def read_line_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None
                     ) -> DataFrame:
    """New lines of new files, with their file's place in the feed."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir)
    return lines.select(
        "value",
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def land_batch(batch: DataFrame, landing_dir: str, fmt: str = "csv",
               arrival_time: Column | None = None, batch_id: str | None = None) -> None:
    """Parse one micro-batch and land it as one batch of the landing area.

    The batch is a plain scan of the new files, so the line position inside
    a split is deterministic; lines arrive when their file was written (default of
    ``arrival_time``).  A retried batch therefore has the same rows, and under its
    ``batch_id`` it replaces what it landed before, bad lines included.
    """
    tagged = batch.select(
        "value",
        F.struct("file_time", "file", "block", F.monotonically_increasing_id().alias("pos")).alias("ingest_seq"))
    parse = parse_csv_lines if fmt == "csv" else parse_json_lines
    when = F.col("ingest_seq.file_time") if arrival_time is None else arrival_time
    events = parse(tagged, arrival_time=when)
    write_landing(events.select(*COMMON_EVENT_COLUMNS, "ingest_seq"), landing_dir, batch_id=batch_id)


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that the stream keeps in its checkpoint: the same after a restart,
    another one for another checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint_dir}/metadata", wholetext=True).first()[0])["id"]


def start_landing_stream(spark: SparkSession, source_dir: str, landing_dir: str, checkpoint_dir: str,
                         fmt: str = "csv", available_now: bool = True,
                         processing_time: str | None = None, arrival_time: Column | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental landing; the checkpoint records which files are done."""
    lines = read_line_stream(spark, source_dir, max_files_per_trigger)
    writer = (lines.writeStream
              .option("checkpointLocation", checkpoint_dir)
              .foreachBatch(lambda batch, n: land_batch(batch, landing_dir, fmt, arrival_time,
                                                        f"{stream_id(spark, checkpoint_dir)}-{n}")))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
