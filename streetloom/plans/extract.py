"""Archives to JSON-LD records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.functions import content, jsonld
from streetloom.operators import counters, crawl, tables
from streetloom.schemas import RECORD_SCHEMA
from streetloom.session import scratch_folder
from streetloom.sources import archive, files, manifest, runs


def extract_records(scan: DataFrame, parser: bool = False) -> DataFrame:
    """Parsed JSON-LD documents that mention a postal address, with their crawl metadata."""
    pages = crawl.decode_bodies(crawl.html_responses(archive.good_records(scan)))
    pages = crawl.mentions_address(pages).select("file_id", "data", "crawl_metadata")
    scripts = crawl.mentions_address(crawl.ld_json_scripts(pages, parser=parser))
    return crawl.json_records(scripts)


def page_results(scan: DataFrame) -> DataFrame:
    """One thin row per archive record: script texts, counter keys, error.

    Written out once, it gives records, counters, errors and the list of finished files
    without a second pass over the archives.
    """
    header = F.col("http_content_type")
    page = (F.col("rec_type") == "response") & content.is_markup(content.media_type(header))
    named = tables.bind(scan, {"charset": F.when(page, content.charset(header)), "page": page})
    decoded = named.withColumn(
        "decoded", content.decode_body(F.when(F.col("page"), F.col("body")), F.col("charset"))
    )
    mentions = F.lower(F.col("decoded.text")).contains("postaladdress")
    hits = tables.bind(decoded, {"hit": F.when(mentions, F.col("decoded.text"))})
    judged = tables.bind(hits, {"is_json": jsonld.is_json(F.col("hit"))})
    texts = F.filter(
        jsonld.script_texts(F.when(~F.col("is_json"), F.col("hit"))),
        lambda text: F.lower(text).contains("postaladdress"),
    )
    unknown = F.concat(F.lit("error/charset_unknown/"), F.col("charset"))
    keys = F.concat(
        counters.record_keys(),
        F.array_compact(
            F.array(
                F.when(F.col("page") & ~F.col("decoded.known"), unknown),
                F.when(F.col("is_json"), F.lit("error/parsel/not_html")),
            )
        ),
    )
    return judged.select(
        "file_id",
        "ordinal",
        crawl.crawl_metadata(),
        F.when(F.col("error").isNull(), keys).alias("keys"),
        texts.alias("texts"),
        "error",
    )


def result_records(results: DataFrame) -> DataFrame:
    texts = results.select("file_id", "crawl_metadata", F.explode("texts").alias("data"))
    return crawl.json_records(texts)


def result_counters(results: DataFrame) -> DataFrame:
    counted = counters.count_keys(results, F.col("keys"))
    texts = results.select("file_id", F.explode_outer("texts").alias("text"))
    bad = F.col("text").isNotNull() & jsonld.parse_json(F.col("text")).isNull()
    failed = F.array_compact(F.array(F.when(bad, F.lit("error/json/decode_error"))))
    return counters.add_counters(counted, counters.count_keys(texts, failed))


TABLES = ["records", "stats", "errors", "done"]
STATS = "file_id string, part string, key string, value long, run string, segment string"
ERRORS = "file_id string, ordinal long, error string, run string"
DONE = "file_id string, run string"
RECORDS = T.StructType(
    [T.StructField("file_id", T.StringType()), T.StructField("part", T.StringType())]
    + RECORD_SCHEMA.fields
    + [T.StructField("run", T.StringType()), T.StructField("segment", T.StringType())]
)


def finished(spark: SparkSession, out: str) -> DataFrame:
    """(file_id, run): archives that were read to their end, and the run that counts for each."""
    return runs.owners(spark, out, runs.committed(spark, out, "done", DONE), "file_id")


def _owned(rows: DataFrame, done: DataFrame) -> DataFrame:
    return rows.join(done, ["file_id", "run"], "left_semi")


def read_records(spark: SparkSession, out: str) -> DataFrame:
    """Records of all finished archives: file_id, part, data, crawl_metadata, run, segment."""
    return _owned(runs.committed(spark, out, "records", RECORDS, "json"), finished(spark, out))


def read_stats(spark: SparkSession, out: str) -> DataFrame:
    """Counters of all finished archives: file_id, part, key, value, run, segment."""
    return _owned(runs.committed(spark, out, "stats", STATS), finished(spark, out))


def read_errors(spark: SparkSession, out: str) -> DataFrame:
    """What went wrong in committed runs, also with archives that a later run finished."""
    return runs.committed(spark, out, "errors", ERRORS)


def run(
    spark: SparkSession,
    todo: DataFrame,
    out: str,
    root: str = "",
    tasks: int | None = None,
    name: str | None = None,
    parts: DataFrame | None = None,
) -> str:
    """Extract the archives of a manifest frame into the tables below ``out``; returns the run.

    ``records`` (gzip JSON by segment), ``stats``, ``errors`` and ``done``, each in a folder of
    this run, which counts once its commit is written: a run that stops anywhere before leaves
    nothing that readers see, and starting again adds no row twice.  A file that fails leaves
    an error and no records, and stays pending.  Finished files are left out, and a file
    listed twice is read once.  ``parts`` (from `archive.archive_ranges`) lets many tasks share
    the archives it lists; others are read whole.  ``name`` repeats a run: nothing happens if it was committed.
    """
    name = name or runs.new_name()
    if runs.is_committed(spark, out, name):
        return name
    with scratch_folder(spark, "extract") as stage:
        listed = manifest.pending(todo.select("file_id").distinct(), finished(spark, out))
        listed.write.parquet(f"{stage}/todo")
        todo = spark.read.parquet(f"{stage}/todo")
        if parts is None:
            scan = archive.scan_archives(todo, root, tasks)
        else:
            zero = F.lit(0).cast("long")
            cut = todo.join(parts, "file_id", "left").withColumns(
                {"start": F.coalesce("start", zero), "first": F.coalesce("first", zero)}
            )
            scan = archive.scan_ranges(cut, root, tasks)
        page_results(scan).where(
            "size(texts) > 0 or size(keys) > 0 or error is not null"
        ).write.parquet(f"{stage}/results")
        results = spark.read.parquet(f"{stage}/results")
        errors = results.where("error is not null").select("file_id", "ordinal", "error")
        broken = errors.select("file_id").distinct()
        whole = results.join(broken, "file_id", "left_anti")

        def at(table: str) -> str:
            return runs.folder(out, table, name)

        records = manifest.with_segment(result_records(whole))
        files.write_records(records, at("records"), "overwrite")
        stats = manifest.with_segment(result_counters(whole))
        stats.write.mode("overwrite").partitionBy("segment").parquet(at("stats"))
        errors.write.mode("overwrite").parquet(at("errors"))
        todo.join(broken, "file_id", "left_anti").write.mode("overwrite").parquet(at("done"))
        runs.commit(spark, out, name)
    return name
