"""Date-partitioned tables: scans, partition lists, latest partition, date sync.

Partition values are zero-padded strings (year=2024/month=01/day=03).
String order equals date order only with padding; the session keeps
``partitionColumnTypeInference`` off so they are never read as INT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirewave.functions import rules

P = rules.PARTITION_COLUMNS


def read_partitioned(spark: SparkSession, root: str, schema: StructType | None = None,
                     merge_schema: bool = False) -> DataFrame:
    """SRC-03: Parquet scan of a Hive-style date-partitioned folder."""
    r = spark.read.option("basePath", root)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(root)


def date_filter(year: str, month: str, day: str) -> Column:
    return (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)


# SRC-01
def scan_partition(spark: SparkSession, root: str, year: str, month: str, day: str) -> DataFrame:
    """One date partition; the equality filter on partition columns prunes directories."""
    return read_partitioned(spark, root).where(date_filter(year, month, day))


def scan_dates(spark: SparkSession, root: str, dates: DataFrame, schema: StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    """All partitions listed in ``dates`` (year, month, day), and only those.

    The list is bounded by the calendar: it is collected once and becomes a
    literal filter on the partition columns, so the scan lists and reads the
    requested directories alone.
    """
    keys = sorted({tuple(r) for r in dates.select(*P).collect()})
    if merge_schema and keys:
        paths = [f"{root.rstrip('/')}/year={y}/month={m}/day={d}" for y, m, d in keys]
        return spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths)
    return read_partitioned(spark, root, schema).where(dates_filter(keys))


def dates_filter(keys: list[tuple[str, str, str]]) -> Column:
    """Literal filter on the partition columns for a list of (year, month, day)."""
    return F.concat_ws("/", *P).isin([f"{y}/{m}/{d}" for y, m, d in keys]) if keys else F.lit(False)


# SRC-04 / ORD-01
def list_partitions(df: DataFrame) -> DataFrame:
    """Sorted distinct (year, month, day) of a partitioned frame."""
    return df.select(*P).distinct().orderBy(*P)


# SRC-05
def latest_partition(df: DataFrame) -> DataFrame:
    """Lexicographic max of [year, month, day]: one partial aggregate, one row."""
    return df.select(F.max(F.struct(*P)).alias("k")).select("k.*")


# SRC-09
def single_partition(df: DataFrame) -> tuple[str, str, str]:
    """The (year, month, day) of a frame that is promised to hold one date; raises when it holds none or several."""
    found = df.select(*P).distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"one partition expected, found {'none' if not found else 'several'}")
    return tuple(found[0])


# SRC-06 / JON-04 / SET-03
def remaining_dates(src_dates: DataFrame, dest_dates: DataFrame | None) -> DataFrame:
    """Dates still to sync = source - destination.

    * destination missing (None) -> every source date;
    * nothing left -> the latest destination date (it is redone; the
      dynamic overwrite keeps that idempotent).

    The fallback is a union guarded by NOT EXISTS — no action, no driver branch.
    """
    src = src_dates.select(*P).distinct()
    if dest_dates is None:
        return src
    dest = dest_dates.select(*P).distinct()
    left = src.join(dest, P, "left_anti")
    fallback = latest_partition(dest).where(~left.exists())
    return left.unionByName(fallback)
