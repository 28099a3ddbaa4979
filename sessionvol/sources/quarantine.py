"""Vendor files read one by one in effect, by one scan: a file that fails is left out and reported, the others go on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionvol.plans.joins import lookup_join
from sessionvol.session import settle, with_settings

#: Columns of these names must hold a time or a day, whatever type they are read as.
TIMES = ("datetime", "date")
_FIELD = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a comma outside quotes
_FIRST_OF_TUPLE = r"""^\(\s*['"]?([^,'"]+)['"]?\s*,.*\)$"""
FAILED = "file string, ticker string, reason string, n_rows bigint"
OPEN_COST = 256 * 1024  # bytes of text that are read in the time a small file takes to open: a task gets up to 512 files, not 32


def header_names(header: Column) -> Column:
    """The column names of a CSV header, as ``feeds.feed_name`` gives them."""

    def named(field: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(F.trim(field), '^"|"$', ""), '""', '"')
        return F.lower(F.trim(F.regexp_replace(bare, _FIRST_OF_TUPLE, "$1")))

    return F.transform(F.split(header, _FIELD), named)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file, with its file and ticker, and what orders the lines of a file."""
    lines = spark.read.schema("value string, ticker string").option("basePath", path).text(path)
    start = F.col("_metadata.file_block_start")
    return lines.select("value", "ticker", F.col("_metadata.file_path").alias("file"), F.struct(start.alias("start"), F.monotonically_increasing_id().alias("line")).alias("place"))


def _stored_lines(spark: SparkSession, path: str) -> DataFrame:
    """``_lines`` in one table: files are listed and opened once, however many there are.

    Folders are listed by a few tasks for each core, not by one task for each folder up to 10,000, and small files are read many to a task.
    """
    listing = 4 * spark.sparkContext.defaultParallelism
    with with_settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=listing, spark__sql__files__openCostInBytes=OPEN_COST):
        return settle(_lines(spark, path))


def read_feed_files(
    spark: SparkSession, path: str, columns: dict[str, str], times: Sequence[str] = TIMES
) -> tuple[DataFrame, DataFrame]:
    """Rows of the sound CSV files in folders named ``ticker=ABC``, and the failed files: file, ticker, reason, n_rows.

    ``columns`` maps lower-case names to types. They are found by name in each file's own header, its first line, so files may differ in the order
    and number of their columns. A file fails if its header lacks one of them, or if one of its lines (n_rows of them) has another number of fields than the header, a
    field that isn't of its column's type, or something else than a time in a column of ``times``. Empty fields are NULL, empty lines and
    lines that repeat the header are none. A file without any line isn't seen; its ticker has no rows.

    One scan of the files, whose lines are stored as Parquet: opening a file costs more than its lines. From these the headers, one row
    each, combined in the tasks; and the rows, which are stored before failed files
    are taken out by an anti-join. So any number of files, and files of any size, are read in parallel. Runs jobs when called.
    """
    lines = _stored_lines(spark, path)
    wanted = [c for c in columns if c != "ticker"]
    heads = lines.groupBy("file", "ticker").agg(F.min_by("value", "place").alias("header"))
    names = heads.withColumn("names", header_names(F.col("header")))
    lacking = F.filter(F.array(*map(F.lit, wanted)), lambda c: ~F.array_contains("names", c))
    heads = settle(names.select("file", "ticker", "header", F.size("names").alias("n"), F.array_join(lacking, ", ").alias("lacks"), *[
        F.array_position("names", c).cast("int").alias(f"at_{k}") for k, c in enumerate(wanted)
    ]))
    sound = heads.filter("lacks = ''").drop("lacks", "ticker")
    widest = sound.agg(F.max("n")).first()[0] or 1

    known = lookup_join(lines.filter(F.trim("value") != "").drop("place"), sound, ["file"], "inner").filter(F.col("value") != F.col("header"))
    # A line of its header's number of fields becomes one of the widest header's.
    padded = F.concat("value", F.repeat(F.lit(","), F.lit(widest) - F.col("n")))
    fields = ", ".join([*(f"c{k} string" for k in range(widest)), "broken string"])
    parsed = known.withColumn("f", F.from_csv(padded, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}))
    texts = F.array(*[F.col(f"f.c{k}") for k in range(widest)])
    bad, out = F.col("f.broken").isNotNull(), []
    for k, c in enumerate(wanted):
        text = F.get(texts, F.col(f"at_{k}") - 1)
        value = text.try_cast(columns[c])
        bad |= text.isNotNull() & (text.try_cast("timestamp") if c in times else value).isNull()
        out.append(value.alias(c))
    rows = settle(parsed.select("file", "ticker", *out, bad.alias("_bad")))

    by_header = heads.filter("lacks <> ''").select("file", "ticker", F.concat(F.lit("no column "), "lacks").alias("reason"), F.lit(0).cast("bigint").alias("n_rows"))
    by_row = rows.filter("_bad").groupBy("file", "ticker").agg(F.lit("malformed rows").alias("reason"), F.count(F.lit(1)).alias("n_rows"))
    failed = settle(by_header.union(by_row))
    gone = failed.filter("n_rows > 0").select("file", F.lit(True).alias("gone"))
    kept = lookup_join(rows, gone, ["file"], "left").filter("gone IS NULL")
    return kept.select(*columns, *(["ticker"] if "ticker" not in columns else [])), failed
