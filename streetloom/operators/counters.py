"""Counters by slash-separated key, per archive file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions import content


def record_keys() -> Column:
    """Counter keys of one archive record, before its body is looked at."""
    header = F.col("http_content_type")
    media = content.media_type(header)
    response = F.col("rec_type") == "response"
    markup = response & header.isNotNull() & content.is_markup(media)
    shown = F.coalesce(media, F.lit("None"))
    charset = F.coalesce(content.charset(header), F.lit("None"))
    return F.array_compact(
        F.array(
            F.lit("warc/record"),
            F.when(response, F.lit("warc/response")),
            F.when(response, F.concat(F.lit("warc/content_type/"), shown)),
            F.when(markup, F.lit("warc/html_response")),
            F.when(markup, F.concat(F.lit("response/charset/"), charset)),
        )
    )


def older_record_keys() -> Column:
    """Counter keys of the older preprocessing: how far each record gets."""
    header = F.col("http_content_type")
    response = F.col("rec_type") == "response"
    typed = response & header.isNotNull()
    markup = typed & content.is_markup(F.lower(header))
    marked = markup & F.lower(content.latin1(F.col("body"))).contains(content.ADDRESS_MARK)
    return F.array_compact(
        F.array(
            F.when(response, F.lit("preprocess:response")),
            F.when(typed, F.lit("preprocess:has_content_type")),
            F.when(markup, F.lit("preprocess:xml_content_type")),
            F.when(marked, F.lit("preprocess:contains_address")),
        )
    )


def count_keys(records: DataFrame, keys: Column, by: Sequence[str] = ("file_id",)) -> DataFrame:
    """(file_id, key, value): how often each key occurs.  Counts combine before the shuffle."""
    return (
        records.select(*by, F.explode(keys).alias("key"))
        .groupBy(*by, "key")
        .agg(F.count(F.lit(1)).alias("value"))
    )


def add_counters(*tables: DataFrame) -> DataFrame:
    """Sum of several counter tables."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    keys = [c for c in out.columns if c != "value"]
    return out.groupBy(*keys).agg(F.sum("value").alias("value"))


def filter_prefix(counters: DataFrame, prefix: str) -> DataFrame:
    return counters.where(F.col("key").startswith(prefix))


def sum_prefix(counters: DataFrame, prefix: str, by: Sequence[str] = ()) -> DataFrame:
    total = F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("value")
    return filter_prefix(counters, prefix).groupBy(*by).agg(total)


def stats_json(counters: DataFrame) -> DataFrame:
    """One JSON object of counters per file; its size is the number of distinct keys."""
    entries = F.sort_array(F.collect_list(F.struct("key", "value")))
    return counters.groupBy("file_id").agg(
        F.to_json(F.map_from_entries(entries)).alias("stats")
    )
