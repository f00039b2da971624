"""Incremental intake: new manifest files are extracted as they arrive.

Each micro-batch is one run of the extract job, with its records, counters, errors and list of
finished files.  The checkpoint remembers which manifest files were taken; the run is named by
the stream and the batch, so a batch that the stream repeats after a crash replaces what it
left, or has nothing to do if it was committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streetloom.plans import extract
from streetloom.sources import manifest


def manifest_stream(spark: SparkSession, folder: str, files_per_batch: int = 10) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return manifest.manifest_lines(lines)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; a new checkpoint has a new one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def start(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    root: str = "",
    tasks: int | None = None,
    files_per_batch: int = 10,
) -> StreamingQuery:
    """Extract everything that has arrived into the tables of the extract job, then stop."""

    def take(listed: DataFrame, batch: int) -> None:
        session = listed.sparkSession
        name = f"stream-{stream_id(session, checkpoint)}-{batch}"
        extract.run(session, listed, out, root, tasks, name)

    return (
        manifest_stream(spark, folder, files_per_batch)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
