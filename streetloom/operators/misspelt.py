"""Read misspelt names: the known text within two edits of what was written.

Two texts within two edits (an exchange of neighbours counts as one) share a text that is left
of each when at most two letters are left out.  So short texts meet under the hashes of all
such rests, by one equality join, and the pairs that meet are verified by the distance itself.
Rests grow with the square of the length.  Longer texts therefore meet under pieces: the known
one is cut into five, two edits touch at most four of them, and the fifth stands in the other
text, at most two places away.  Both ways are exact: no pair within two edits is lost.

Texts are compared as `match_text` leaves them, each distinct text once.  The number of rows
that one key brings together is that of distinct texts with a common rest or piece, and they
are verified in the task that joins them; AQE splits a piece that very many names share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions.address import match_text
from streetloom.functions.similarity import one_edit, within_two_edits
from streetloom.operators.tables import bind

#: Longest known text that is found by its rests, and the pieces of longer ones.
SHORT, PIECES = 20, 5


def _left_out(text: Column) -> Column:
    """All texts with one letter left out."""
    rests = F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
    )
    return F.when(F.length(text) > 0, rests).otherwise(F.array().cast("array<string>"))


def _rests(text: Column) -> Column:
    once = _left_out(text)
    return F.concat(F.array(text), once, F.flatten(F.transform(once, _left_out)))


def _cut(size: Column, piece: Column) -> Column:
    return F.floor(size * piece / PIECES).cast("int")


def _piece_name(size: Column, piece: Column, text: Column) -> Column:
    return F.concat_ws("\x1f", F.lit("piece"), size.cast("string"), piece.cast("string"), text)


def _pieces(text: Column) -> Column:
    size = F.length(text)
    numbers = F.array(*[F.lit(i) for i in range(PIECES)])

    def piece(i: Column) -> Column:
        start, end = _cut(size, i), _cut(size, i + 1)
        return _piece_name(size, i, F.substring(text, start + 1, end - start))

    return F.transform(numbers, piece)


def _places_of_pieces(text: Column) -> Column:
    """What the pieces of a longer known text would be if it were within two edits of ``text``."""
    tried = [
        F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(s).alias("s"))
        for d in range(-2, 3) for i in range(PIECES) for s in range(-2, 3)
    ]

    def piece(t: Column) -> Column:
        size = F.length(text) + t["d"]
        start, end = _cut(size, t["i"]) + t["s"], _cut(size, t["i"] + 1) + t["s"]
        inside = (size > SHORT) & (start >= 0) & (end <= F.length(text))
        return F.when(inside, _piece_name(size, t["i"], F.substring(text, start + 1, end - start)))

    return F.array_compact(F.transform(F.array(*tried), piece))


def _keys(texts: DataFrame, name: str, short: Column, long: Column) -> DataFrame:
    """(key, name): the hashes under which each text is met."""
    none = F.array().cast("array<string>")
    text = F.col(name)
    names = F.concat(F.when(short, _rests(text)).otherwise(none), long)
    hashes = F.array_distinct(F.transform(names, lambda n: F.xxhash64(n)))
    return texts.select(name, F.explode(hashes).alias("key"))


def known_keys(known: DataFrame) -> DataFrame:
    """(match, key) of known texts (column ``match``); may be kept as a table and given again."""
    size = F.length("match")
    pieces = F.when(size > SHORT, _pieces(F.col("match"))).otherwise(F.array().cast("array<string>"))
    return _keys(known, "match", size <= SHORT, pieces)


def near_texts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(text, match, distance): every known text within two edits of each text.

    ``texts`` has the column ``text``, ``keys`` are `known_keys`; both without repeats or nulls.
    """
    size = F.length("text")
    none = F.array().cast("array<string>")
    places = F.when(size > SHORT - 2, _places_of_pieces(F.col("text"))).otherwise(none)
    asked = _keys(texts, "text", size <= SHORT + 2, places)
    met = asked.join(keys, "key").where(F.abs(F.length("text") - F.length("match")) <= 2)
    # two exchanges of neighbours are four plain edits
    met = met.where(F.levenshtein("text", "match", 4) >= 0)
    pairs = met.select("text", "match").distinct()
    pairs = pairs.where(within_two_edits(F.col("text"), F.col("match")))
    steps = F.when(F.col("text") == F.col("match"), 0).when(
        one_edit(F.col("text"), F.col("match")), 1
    )
    return pairs.select("text", "match", F.coalesce(steps, F.lit(2)).alias("distance"))


def allowed_edits(text: Column) -> Column:
    """How many edits a text may be away: none below four letters, one below eight, else two."""
    return F.when(F.length(text) < 4, 0).when(F.length(text) < 8, 1).otherwise(2)


def read_misspelt(df: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    """Add ``read_as``, ``edits``: the known text nearest to ``column``, and how far it is.

    ``known`` has the texts in its column ``name``.  Both are compared as `match_text`; the
    smallest text wins ties.  Null, blank and unreadable texts have null in both columns.  All
    rows of ``df`` are kept; columns of these two names are replaced.
    """
    df = bind(df.drop("read_as", "edits"), {"__text": match_text(F.col(f"`{column}`"))})
    texts = df.select(F.col("__text").alias("text")).where("text is not null").distinct()
    towns = known.select(match_text(F.col(f"`{name}`")).alias("match")).where("match is not null")
    pairs = near_texts(texts, known_keys(towns.distinct()))
    pairs = pairs.where(F.col("distance") <= allowed_edits(F.col("text")))
    best = pairs.groupBy(F.col("text").alias("__text")).agg(
        F.min(F.struct("distance", "match")).alias("__best")
    )
    return (
        df.join(best, "__text", "left")
        .withColumn("read_as", F.col("__best.match"))
        .withColumn("edits", F.col("__best.distance"))
        .drop("__text", "__best")
    )


def correct_towns(queries: DataFrame, places: DataFrame) -> DataFrame:
    """Queries for `geocode.geocode` with ``city`` put right where it is a misspelt locality."""
    read = read_misspelt(queries, "city", places, "locality")
    city = F.when(F.col("edits") > 0, F.col("read_as")).otherwise(F.col("city"))
    return read.withColumn("city", city).drop("read_as", "edits").select(queries.columns)
