"""An index of places that look-ups share: bucketed tables, brought up to date by changes only.

A folder holds two tables.  ``keys`` has the place that answers each key, bucketed by key;
``places`` has the places, bucketed by id.  A look-up joins both as they lie: only the queries
are shuffled.  Each merge adds one generation of rows to both tables and counts once its commit
is written (`streetloom.sources.buckets`); readers take the latest committed row of each key and
of each place, which their bucket holds, so reading needs no shuffle either.

A merge works out keys of changed places only.  A key whose place changed or went is answered
anew from all places that have it; any other key only if a changed place comes before its own.
A key has one row per generation, so keys that very many places share stay small.  An index
that outgrows its buckets is laid out in more by the merge that fills them.

Merges of one index run one after the other.  Place ids are unique.  Defined results: a place
without any of the texts has no key; places equal to what the index has are no change; a
removed place that the index does not know is ignored; an empty table of places removes
nothing by `merge`, and everything by `update`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.operators import geocode
from streetloom.session import scratch_folder
from streetloom.sources import buckets

FIELDS = [
    "name", "house_number", "road", "postcode", "locality", "region", "country", "country_code",
]
#: Name, columns and bucket key of the two tables.
KEYS = ("keys", "key STRING, place_id BIGINT", "key")
PLACES = ("places", ", ".join(["place_id BIGINT", *[f"{f} STRING" for f in FIELDS], "live BOOLEAN"]), "place_id")


def create(spark: SparkSession, folder: str, places: DataFrame, files: int = buckets.BUCKETS) -> None:
    """A new index in a folder not yet in use, of ``files`` buckets or as many as it needs."""
    buckets.lay_out(spark, folder, files)
    merge(spark, folder, places)


def key_index(spark: SparkSession, folder: str) -> DataFrame:
    """(key, place_id) for `geocode.geocode`: the one place that answers each key."""
    latest = buckets.committed(spark, folder, *KEYS).groupBy("key").agg(
        F.max_by("place_id", "gen").alias("place_id")
    )
    return latest.where(F.col("place_id").isNotNull())


def current_places(spark: SparkSession, folder: str) -> DataFrame:
    """The places of the index."""
    row = F.struct("live", *FIELDS)
    latest = buckets.committed(spark, folder, *PLACES).groupBy("place_id").agg(
        F.max_by(row, "gen").alias("row")
    )
    return latest.where("row.live").select("place_id", *[f"row.{f}" for f in FIELDS])


def changes(spark: SparkSession, folder: str, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a whole table of places changes: (places new or different, ids that are gone)."""
    ours = current_places(spark, folder).select(
        "place_id", F.struct(*FIELDS).alias("ours")
    )
    theirs = places.select("place_id", F.struct(*FIELDS).alias("theirs"))
    both = ours.join(theirs, "place_id", "full_outer")
    changed = both.where(F.col("theirs").isNotNull() & ~F.col("ours").eqNullSafe(F.col("theirs")))
    gone = both.where(F.col("theirs").isNull()).select("place_id")
    return changed.select("place_id", "theirs.*"), gone


def merge(
    spark: SparkSession, folder: str, changed: DataFrame, removed: DataFrame | None = None
) -> int:
    """Take over new or different places and drop ``removed`` ones (place_id); returns the generation."""
    gen = buckets.next_generation(spark, folder)
    with scratch_folder(spark, "merge") as stage:

        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{stage}/{name}")
            return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

        changed = staged(changed.select("place_id", *FIELDS), "changed")
        rows = changed.withColumn("live", F.lit(True))
        if removed is not None:
            absent = removed.select("place_id").distinct().join(changed, "place_id", "left_anti")
            texts = [F.lit(None).cast("string").alias(f) for f in FIELDS]
            gone = staged(absent.select("place_id", *texts, F.lit(False).alias("live")), "removed")
            rows = rows.unionByName(gone)
        best = staged(geocode.place_index(changed), "best")
        if buckets.generations(spark, folder):
            best = _answers(spark, folder, rows, best, staged)
        layout = buckets.room(spark, folder, [PLACES, KEYS], max(rows.count(), best.count()))
        buckets.append(spark, folder, layout, *PLACES, rows, gen)
        buckets.append(spark, folder, layout, *KEYS, best, gen)
        buckets.commit(spark, folder, layout, gen)
    return gen


def _answers(spark: SparkSession, folder: str, rows: DataFrame, best: DataFrame, staged) -> DataFrame:
    """(key, place_id) of the keys whose place changes; null where no place is left."""
    index = key_index(spark, folder)
    ids = rows.select("place_id")
    lost = staged(index.join(ids, "place_id", "left_semi").select("key"), "lost")
    others = current_places(spark, folder).join(ids, "place_id", "left_anti")
    left = geocode.place_postings(others).join(lost, "key", "left_semi")
    again = left.unionByName(best).groupBy("key").agg(F.min("place_id").alias("place_id"))
    anew = lost.join(again, "key", "left").select("key", "place_id")
    ours = index.withColumnRenamed("place_id", "ours")
    first = best.join(lost, "key", "left_anti").join(ours, "key", "left")
    first = first.where(F.col("ours").isNull() | (F.col("place_id") < F.col("ours")))
    return staged(anew.unionByName(first.select("key", "place_id")), "answers")


def update(spark: SparkSession, folder: str, places: DataFrame) -> int:
    """Bring the index to a whole table of places; only the differences are merged."""
    return merge(spark, folder, *changes(spark, folder, places))


def rewrite(spark: SparkSession, folder: str, into: str, files: int = buckets.BUCKETS) -> None:
    """The same index in a new folder, as one generation."""
    create(spark, into, current_places(spark, folder), files)
