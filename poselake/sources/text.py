"""Shared parts of the text scans: whole files as rows, records as numbered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def whole_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, value): one row per file, line ends as ``\\n``. Files are one molecule's or one receptor's, so they fit a row."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    df = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return df.withColumn("value", F.regexp_replace("value", "\r\n?", "\n"))


def counted(df: DataFrame, number: str) -> DataFrame:
    """``df``, as a file scan gave it, with a running number from 0 in each file; files are split between tasks.

    One more pass counts the rows of each split; a number is the place in the split plus the rows of the splits before.
    """
    placed = df.withColumns({"__path": F.col("_metadata.file_path"), "__split": F.col("_metadata.file_block_start"), "__id": F.monotonically_increasing_id()})
    splits = placed.groupBy("__path", "__split").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = Window.partitionBy("__path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    base = splits.select("__path", "__split", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__base"))
    return placed.join(base, ["__path", "__split"]).withColumn(number, F.col("__id") + F.col("__base")).drop("__split", "__id", "__base")


def records(spark: SparkSession, path: str | list[str], end: str, pattern: str | None = None) -> DataFrame:
    """(path, value, record_no): records of large files that end with ``end``, numbered from 0 in each file; files are split between tasks."""
    reader = spark.read.option("lineSep", end)
    df = counted((reader.option("pathGlobFilter", pattern) if pattern else reader).text(path), "record_no")
    return df.select(F.col("__path").alias("path"), F.regexp_replace("value", "\r\n?", "\n").alias("value"), "record_no")


def numbered(df: DataFrame, pieces: Column, number: str, piece: str) -> DataFrame:
    """``df`` with a row per element of ``pieces`` and its 0-based number."""
    return df.select(*[c for c in df.columns if c != "value"], F.posexplode(pieces).alias(number, piece))


def lines(df: DataFrame) -> DataFrame:
    """(path, line_no, line), numbered from 1."""
    return df.select("path", F.posexplode(F.split("value", "\n")).alias("n", "line")).select("path", (F.col("n") + 1).alias("line_no"), "line")


def stem(path: Column) -> Column:
    """File name without folder and last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")


def number(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")
