"""De-duplication of records on a stream, with state that expires.

Pages are crawled again and again; a record that says the same as an earlier one of the same page adds
nothing.  The event time is the crawl date of a record.  The state holds one entry per distinct key for
``delay`` behind the latest date seen, so it is bounded by the records of that span, however
long the stream runs.  A copy is found if it arrives before its first record expires; records
older than the watermark count as late and are dropped by Spark.

Defined results: a record whose date cannot be read has no place in time; it is kept, copies
included, and never enters the state.  Null keys are equal to each other.  Which of several
equal records of one batch is kept is open; they agree on all keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streetloom.schemas import METADATA_SCHEMA

#: Records as text: equal documents have equal texts, whatever later steps parse.
TEXT_RECORD = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("crawl_metadata", METADATA_SCHEMA),
    ]
)


def crawl_time(date: Column) -> Column:
    """The time of a crawl date as archives write it (with or without fractions); null if odd."""
    return F.try_to_timestamp(date)


def record_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Record files (JSON lines) of a folder and those below it, as they arrive."""
    return (
        spark.readStream.schema(TEXT_RECORD)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .option("mode", "FAILFAST")
        .json(folder)
    )


def distinct_records(
    records: DataFrame, date: Column, keys: dict[str, Column], delay: str = "30 days"
) -> DataFrame:
    """``records`` (a stream) without those whose ``keys`` were seen within ``delay``.

    ``seen_at`` is added, the time read from ``date``.
    """
    timed = records.withColumns({**keys, "seen_at": crawl_time(date)})
    known = (
        timed.where(F.col("seen_at").isNotNull())
        .withWatermark("seen_at", delay)
        .dropDuplicatesWithinWatermark(list(keys))
    )
    return known.unionByName(timed.where(F.col("seen_at").isNull()))


def same_page(records: DataFrame) -> dict[str, Column]:
    """Keys under which two records say the same of one page."""
    return {"url": F.col("crawl_metadata.url"), "content": F.md5("data")}


def start(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    delay: str = "30 days",
    files_per_batch: int = 100,
    columns: Sequence[str] = ("file_id", "data", "crawl_metadata", "seen_at"),
) -> StreamingQuery:
    """Write the distinct records of all files that have arrived, exactly once, and stop."""
    records = record_stream(spark, folder, files_per_batch)
    kept = distinct_records(records, F.col("crawl_metadata.warc_date"), same_page(records), delay)
    return (
        kept.select(*columns)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
