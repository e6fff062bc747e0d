"""Dates and files of a partitioned folder from its directory listing alone.

``year=/month=/day=`` folders are expanded first and then listed by a Spark
job (the file index lists many folders in parallel), so a table's dates,
their file counts, bytes and newest changes are known without opening one
data file, whatever the table's size.  Nothing here reads a footer.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.functions import rules

P = rules.PARTITION_COLUMNS
FILES = "year string, month string, day string, path string, bytes bigint, changed timestamp"
#: what tells one state of a date from another
STATE = ["files", "bytes", "newest", "paths"]


def date_dir(root: str, year: str, month: str, day: str) -> str:
    return f"{root.rstrip('/')}/year={year}/month={month}/day={day}"


def list_files(spark: SparkSession, root: str, dates: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(year, month, day, path, bytes, changed) of every Parquet file under ``root``, or under the given dates.

    Values come from the path, so they stay zero-padded text.  A folder that
    is missing or holds no date gives no rows.  Files of unfinished writes
    (names with a leading ``_`` or ``.``) are not listed.
    """
    globs = [f"{root.rstrip('/')}/year=*/month=*/day=*"] if dates is None else [date_dir(root, *d) for d in dates]
    if not globs:
        return spark.createDataFrame([], FILES)
    reader = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
              .option("ignoreMissingFiles", "true"))  # files that go away meanwhile are not listed
    try:
        found = reader.load(globs)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if dates is None or len(dates) == 1:
            return spark.createDataFrame([], FILES)
        there = set(_dates_by_dir(spark, root))
        return list_files(spark, root, [d for d in dates if d in there] or [])
    part = lambda c: F.regexp_extract("path", f"/{c}=([^/]*)/", 1).alias(c)
    return found.select(*[part(c) for c in P], "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def _dates_by_dir(spark: SparkSession, root: str) -> list[tuple[str, str, str]]:
    """Dates that have files; bounded by the calendar."""
    return [tuple(r) for r in list_dates(spark, root).collect()]


def list_dates(spark: SparkSession, root: str) -> DataFrame:
    """SRC-04 / ORD-01 by listing: sorted (year, month, day) that hold a file."""
    return list_files(spark, root).select(*P).distinct().orderBy(*P)


def date_states(files: DataFrame) -> DataFrame:
    """(year, month, day, files, bytes, newest, paths): one row a date, equal as long as its files are.

    ``paths`` is an order-free checksum of path, size and time of change, so a
    file that replaces another is seen even at the same size and second.
    """
    mark = F.xxhash64("path", "bytes", "changed").cast("decimal(20,0)")
    return files.groupBy(*P).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("changed").alias("newest"),
                                 F.sum(mark).cast("string").alias("paths"))


def latest_date(spark: SparkSession, root: str) -> tuple[str, str, str] | None:
    """SRC-05 by listing: the greatest (year, month, day) that holds a file, or None."""
    row = list_files(spark, root).agg(F.max(F.struct(*P)).alias("k")).first()["k"]
    return tuple(row) if row is not None else None
