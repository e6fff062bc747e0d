"""Publish partitioned tables by switching partition locations in the catalog.

A run writes every table's rows under a new version folder of its own.  Only
when all of them are written does the catalog move: partitions of written
dates get the new location, dates left without rows lose theirs.  Until then
(and for good, when the run fails) readers of the tables see the old files; a
partition is never seen half written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hirewave.functions import rules
from hirewave.sinks import writers
from hirewave.sources import listing

P = rules.PARTITION_COLUMNS
VERSION = "version="


@dataclass
class Staged:
    """One table's rows, written but not yet visible."""

    table: str
    root: str
    path: str
    schema: StructType


def quoted(table: str) -> str:
    return ".".join(f"`{p}`" for p in table.split("."))


def stage(df: DataFrame, table: str, root: str) -> Staged:
    """Write ``df`` by date under a version folder that no other run uses."""
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{VERSION}{version}"
    writers.write_partitioned(df, path)
    return Staged(table, root, path, df.schema)


def _create(spark: SparkSession, s: Staged) -> None:
    if "." in s.table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{s.table.split('.')[0]}`")
    cols = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in s.schema.fields if f.name not in P), *(f"`{c}` string" for c in P)])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(s.table)} ({cols}) USING parquet PARTITIONED BY ({', '.join(P)}) LOCATION '{s.root}'")


def _partition(date: tuple[str, str, str]) -> str:
    return "PARTITION ({})".format(", ".join(f"{c}='{v}'" for c, v in zip(P, date)))


def catalog_dates(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    """Dates the catalog lists for ``table`` (bounded by the calendar)."""
    return {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()}


def publish(spark: SparkSession, staged: list[Staged], dates: list[tuple[str, str, str]]) -> None:
    """SNK-01: make the staged rows the tables' rows of ``dates``, in the catalog alone.

    New dates come in one statement a table, known dates change their location
    one by one, and dates of the run without rows go in one statement.  Should
    the catalog fail in between, each date is either old or new, and running
    the same dates again completes the rest.
    """
    steps = []
    for s in staged:
        _create(spark, s)
        written = {tuple(r) for r in listing.list_dates(spark, s.path).collect()}  # bounded by the calendar
        there, q = catalog_dates(spark, s.table), f"ALTER TABLE {quoted(s.table)}"
        spot = lambda d, s=s: f"{_partition(d)} LOCATION '{listing.date_dir(s.path, *d)}'"
        if written - there:
            steps.append(f"{q} ADD IF NOT EXISTS " + " ".join(map(spot, sorted(written - there))))
        steps += [f"{q} {_partition(d)} SET LOCATION '{listing.date_dir(s.path, *d)}'" for d in sorted(written & there)]
        gone = (set(dates) - written) & there
        if gone:
            steps.append(f"{q} DROP IF EXISTS " + ", ".join(map(_partition, sorted(gone))))
    for step in steps:
        spark.sql(step)
    for s in staged:
        spark.catalog.refreshTable(s.table)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete version folders whose every date a newer version holds too; the deleted folders' names.

    The ``keep`` newest versions always stay, for readers still at work on them.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    store = base.getFileSystem(conf)
    names = sorted(s.getPath().getName() for s in (store.listStatus(base) if store.exists(base) else []) if s.getPath().getName().startswith(VERSION))
    newer: set = set()
    gone = []
    for i, name in enumerate(reversed(names)):
        held = {tuple(r) for r in listing.list_dates(spark, f"{root.rstrip('/')}/{name}").collect()}  # bounded by the calendar
        if i >= keep and held <= newer:
            store.delete(jvm.org.apache.hadoop.fs.Path(base, name), True)
            gone.append(name)
        newer |= held
    return gone
