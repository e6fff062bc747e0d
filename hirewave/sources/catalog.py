"""Catalog side: register external partitioned tables, list partitions and tables.

Partition listing goes through the catalog (``SHOW PARTITIONS``), which is
metadata only: it never opens a data file, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.functions import rules

P = rules.PARTITION_COLUMNS


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


# SRC-02: crawl a prefix, infer schema (merged) and partitions, register the table
def register_table(spark: SparkSession, name: str, path: str, database: str | None = None) -> str:
    full = f"{database}.{name}" if database else name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {_q(full)}")
    spark.sql(f"CREATE TABLE {_q(full)} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {_q(full)}")
    return full


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    """SRC-04 on a catalog table: partitions as (year, month, day) columns, sorted."""
    parts = spark.sql(f"SHOW PARTITIONS {_q(table)}")
    spec = F.col("partition")
    return parts.select(*[F.regexp_extract(spec, f"(?:^|/){c}=([^/]*)", 1).alias(c) for c in P]).orderBy(*P)


# SRC-07
def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a registered table."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}")
    return about.where("col_name = 'Location'").first()["data_type"]


def database_exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database)


def table_partitions_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    """Partitions of ``table``, or None when the table (or its database) is missing."""
    if "." in table and not spark.catalog.databaseExists(table.split(".")[0]):
        return None
    if not spark.catalog.tableExists(table):
        return None
    return show_partitions(spark, table)
