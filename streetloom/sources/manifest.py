"""Archive manifests: one archive path per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where archives are published and the suffix of a staged copy.
ARCHIVE_HOST = "https://data.commoncrawl.org/"
ARCHIVE_SUFFIX = ".warc.gz"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_lines(spark.read.text(path))


def manifest_lines(lines: DataFrame) -> DataFrame:
    """Trimmed, non-empty lines as ``file_id``."""
    return lines.select(F.trim("value").alias("file_id")).where(F.col("file_id") != "")


def with_segment(manifest: DataFrame) -> DataFrame:
    """Add ``segment`` (fourth part of the path) and ``part`` (five digits), null if absent."""
    pieces = F.split("file_id", "/")
    part = F.regexp_extract(F.element_at(pieces, -1), r"-(\d{5})\.warc\.gz$", 1)
    return manifest.withColumns(
        {"segment": F.get(pieces, F.lit(3)), "part": F.nullif(part, F.lit(""))}
    )


def well_formed(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("segment").isNotNull() & F.col("part").isNotNull())


def malformed(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("segment").isNull() | F.col("part").isNull())


def head(manifest: DataFrame, n: int) -> DataFrame:
    """The first n archives by path."""
    return manifest.orderBy("file_id").limit(n)


def pending(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Archives without an entry in the table of finished ones."""
    return manifest.join(done.select("file_id").distinct(), "file_id", "left_anti")


def locations(manifest: DataFrame, root: str) -> DataFrame:
    """Add the download URL and the path of a staged copy below ``root``."""
    base = F.concat_ws("/", F.lit(root), F.col("segment"), F.col("part"))
    return manifest.withColumns(
        {
            "url": F.concat(F.lit(ARCHIVE_HOST), F.col("file_id")),
            "base_path": base,
            "download_path": F.concat(base, F.lit(ARCHIVE_SUFFIX)),
        }
    )
