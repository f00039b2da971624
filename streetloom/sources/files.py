"""Readers and writers of the files that pass between the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.schemas import PAIR_SCHEMA, RECORD_SCHEMA, strings

# A text no address holds, so that null and empty text stay apart in CSV files.
CSV_NULL = "\\N"
CSV_OPTIONS = {
    "header": "true",
    "nullValue": CSV_NULL,
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_records(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Gzip JSON lines, one folder per segment if the frame has one."""
    if "segment" not in records.columns:
        records.write.mode(mode).option("compression", "gzip").json(path)
        return
    # brings a segment together in files of even size, a large one in several
    even = records.hint("rebalance", F.col("segment"))
    even.write.mode(mode).option("compression", "gzip").partitionBy("segment").json(path)


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RECORD_SCHEMA,
    arrays: bool = False,
) -> DataFrame:
    """Gzip JSON files below a folder; ``arrays`` for files that hold one JSON array each."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", str(arrays).lower())
        .option("multiLine", str(arrays).lower())
        .option("mode", "FAILFAST")
        .json(path)
    )


def write_sections(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Pair table as Parquet, one folder per section."""
    even = pairs.hint("rebalance", F.col("section"))
    even.write.mode(mode).option("compression", "zstd").partitionBy("section").parquet(path)


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(PAIR_SCHEMA.fields + [T.StructField("section", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def write_dataset(dataset: DataFrame, path: str, mode: str = "errorifexists") -> None:
    dataset.write.mode(mode).option("compression", "zstd").parquet(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _one_line(text: Column) -> Column:
    """The text on one line: a backslash becomes ``\\s``, line breaks ``\\n`` and ``\\r``."""
    return F.replace(
        F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")),
        F.lit("\r"), F.lit("\\r"),
    )


def _all_lines(text: Column) -> Column:
    """Undo `_one_line`."""
    return F.replace(
        F.replace(F.replace(text, F.lit("\\r"), F.lit("\r")), F.lit("\\n"), F.lit("\n")),
        F.lit("\\s"), F.lit("\\"),
    )


def write_csv(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with one line per row: line breaks inside values are escaped, so files can be split."""
    escaped = table.select(
        *[
            _one_line(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in table.schema
        ]
    )
    escaped.write.mode(mode).options(emptyValue='""', **CSV_OPTIONS).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    row_id: bool = True,
) -> DataFrame:
    """CSV of `write_csv` with text columns, and the row number that aligns two such files.

    A line with another number of values fails the read.
    """
    fields = list(strings(*columns).fields)
    if row_id:
        fields = [T.StructField("row_id", T.LongType()), *fields]
    rows = spark.read.schema(T.StructType(fields)).options(
        emptyValue="", mode="FAILFAST", **CSV_OPTIONS
    ).csv(path)
    return rows.withColumns({c: _all_lines(F.col(f"`{c}`")) for c in columns})


def read_outside_csv(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """A CSV of another tool that is aligned by position only, numbered in file order.

    A line of another width fails the read; values with line breaks need ``multi_line``.
    Lines are counted per file split; the number of a line is its place in the split plus the
    lines of the splits before, so a large file is numbered by all tasks at once.
    """
    lines = (
        spark.read.schema(strings(*columns))
        .options(header="true", escape='"', mode="FAILFAST", multiLine=str(multi_line).lower())
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    splits = lines.groupBy("_file", "_split").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_file",
        "_split",
        (F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return lines.join(starts, ["_file", "_split"]).select(
        (F.col("_id") + F.col("_shift")).cast("bigint").alias("row_id"), *columns
    )


def _before(value: str, *by: str) -> Column:
    """Sum of a column over the pieces or splits before, in file order."""
    window = Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _prefixed(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``name``, the sum of ``value`` over all pieces before, by splits first, and ``_total``."""
    splits = pieces.groupBy("_file", "_split").agg(F.sum(value).alias("_sum"))
    total = F.sum("_sum").over(Window.partitionBy("_file"))
    splits = splits.select(
        "_file", "_split", _before("_sum", "_file", "_split").alias("_base"), total.alias("_total")
    )
    inside = pieces.withColumn("_inside", _before(value, "_file", "_split", "_id"))
    joined = inside.join(splits, ["_file", "_split"])
    return joined.withColumn(name, F.col("_base") + F.col("_inside")).drop("_base", "_inside")


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """Elements of files that hold one JSON list of objects each: file, ord, element (text).

    A list is read by as many tasks as the file has splits.  It is cut behind every closing
    brace.  Whether a piece begins inside a string follows from the number of quotes before
    it, how deep it lies from the brackets before it that are no part of strings; both are
    sums per split, then within the split.  An element ends where the depth is back at that
    of the list; its pieces are put together again.  A file that ends inside an element, or
    holds anything but objects, fails the read.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # an escape never reaches over a piece, as no escape ends in a brace
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    pieces = _prefixed(pieces.withColumn("_quotes", quotes), "_quotes", "_quoted").drop("_total")
    inside = F.col("_quoted") % 2 == 1
    outside = F.when(inside, F.regexp_replace(plain, r'^[^"]*"?', "")).otherwise(plain)
    outside = F.regexp_replace(outside, r'"[^"]*("|$)', "")
    opened = F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]]", ""))
    real = (F.col("_quoted") + F.col("_quotes")) % 2 == 0  # the brace behind it is no text
    pieces = pieces.withColumns({"_real": real, "_opened": opened - real.cast("int")})
    # the end of the file counts as one more brace: a list that is closed ends one below
    pieces = _prefixed(pieces, "_opened", "_depth").withColumn("_closed", F.col("_total") == -1).drop("_total")
    ends = F.col("_real") & (F.col("_depth") + F.col("_opened") == 1)
    pieces = _prefixed(pieces.withColumn("_ends", ends.cast("int")), "_ends", "ord")
    whole = pieces.groupBy("_file", "ord").agg(
        F.sort_array(F.collect_list(F.struct("_id", "value"))).alias("_pieces"), F.max("_ends").alias("_whole"),
        F.bool_and("_closed").alias("_closed"),
    )
    text = F.concat(F.array_join(F.col("_pieces.value"), "}"), F.lit("}"))
    element = F.regexp_extract(text, r"(?s)^\s*(?:\[|,)\s*(\{.*\})$", 1)
    rest = F.array_join(F.col("_pieces.value"), "}")
    checked = (
        F.when(F.col("_closed") & (F.col("_whole") == 1) & (element != ""), element)
        .when(F.col("_closed") & (F.col("_whole") == 0) & rest.rlike(r"^\s*(\[\s*)?\]\s*$"), F.lit(None))
        .otherwise(F.raise_error(F.concat(F.lit("not a JSON list of objects: "), F.col("_file"))))
    )
    return whole.select(
        F.col("_file").alias("file"), F.col("ord").cast("bigint").alias("ord"), checked.alias("element")
    ).where(F.col("element").isNotNull())


def read_cell_updates(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Cell updates {row, col, value}; ``ord`` tells which update of a cell is the later one.

    Tools write one JSON list, where ``ord`` is the position (`read_json_list`); ``lines`` is
    for JSON lines that carry ``ord`` themselves.
    """
    fields = [
        T.StructField("row", T.LongType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
    if lines:
        return spark.read.schema(T.StructType([T.StructField("ord", T.LongType()), *fields])).json(path)
    update = F.from_json("element", T.StructType(fields), {"mode": "FAILFAST"})
    return read_json_list(spark, path).select("ord", update.alias("u")).select("ord", "u.row", "u.col", "u.value")


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, options: dict[str, str], tasks: int = 1
) -> DataFrame:
    """Output table of a repair tool in a database.

    ``options`` carry user, password and driver from the caller's secrets.  With ``tasks`` > 1
    the table is read in ranges of its tuple id; pass lowerBound and upperBound as well.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if tasks > 1:
        reader = reader.options(partitionColumn="_tid_", numPartitions=str(tasks))
    return reader.load()
