"""Incremental crawl of a raw folder: footers of new files only, merged schema, groups of equal schema.

The registry is an append-only Parquet folder with one row for each data file
ever seen: path, size, time of change, date, number of rows, and the schema of
its footer.  A crawl lists the folder (no file is opened), reads the footers of
files the registry does not hold in their present state, in one distributed
pass, and appends them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hirewave.functions import rules
from hirewave.sources import listing

P = rules.PARTITION_COLUMNS
KEY = ["path", "bytes", "changed"]
SCHEMA = listing.FILES + ", n_rows bigint, kind string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: the key under which Spark's own Parquet files hold their schema
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def footers(files: DataFrame) -> DataFrame:
    """``files`` with n_rows and kind (the schema as JSON) out of each footer, read by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema

        for b in batches:
            counts, kinds = [], []
            for uri in b.column("path").to_pylist():
                if re.match("file:/|/", uri):
                    store, name = fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
                else:
                    store, name = fs.FileSystem.from_uri(uri)
                with store.open_input_file(name) as f:
                    found = pq.read_metadata(f)
                own = (found.metadata or {}).get(ROW_METADATA)
                counts.append(found.num_rows)
                kinds.append(own.decode() if own else from_arrow_schema(found.schema.to_arrow_schema()).json())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(counts, pa.int64()), pa.array(kinds, pa.string())],
                                             names=[*b.schema.names, "n_rows", "kind"])

    spread = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select(*COLUMNS[:6]).repartition(spread, "path").mapInArrow(run, SCHEMA)


def registry(spark: SparkSession, registry_root: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(registry_root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def crawl(spark: SparkSession, root: str, registry_root: str, files: DataFrame | None = None) -> DataFrame:
    """The files under ``root`` (or ``files`` of a listing) with n_rows and kind; only new files are opened.

    A crawl that dies while it appends registers all of its files or none; a
    file registered twice (by two crawls at once) counts once.
    """
    now = listing.list_files(spark, root) if files is None else files
    new = now.join(registry(spark, registry_root).select(*KEY), KEY, "left_anti")
    if not new.limit(1).isEmpty():
        footers(new).write.mode("append").parquet(registry_root)
    known = registry(spark, registry_root).dropDuplicates(KEY)
    return now.select(*KEY).join(known, KEY).select(*COLUMNS)


def schema_of(kind: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(kind))


def kinds(files: DataFrame) -> list[str]:
    """The different schemas (as JSON) of crawled files, sorted: as many as there are producers."""
    return [r[0] for r in files.select("kind").distinct().orderBy("kind").collect()]


def merged_schema(some: list[str]) -> tuple[StructType, list[str]]:
    """One schema of all columns, and the names that come with several types (which one scan cannot read).

    Columns keep the order of their first appearance; all may be null.
    Partition columns come from the path and are left out.
    """
    fields: dict[str, StructField] = {}
    torn: list[str] = []
    for kind in some:
        for f in schema_of(kind).fields:
            if f.name in P:
                continue
            if f.name not in fields:
                fields[f.name] = StructField(f.name, f.dataType, True)
            elif fields[f.name].dataType != f.dataType and f.name not in torn:
                torn.append(f.name)
    return StructType(list(fields.values())), torn


def groups(spark: SparkSession, root: str, files: DataFrame) -> list[tuple[StructType, list[str]]]:
    """[(schema, paths to read)] that cover ``files`` (of a crawl), one entry for each schema.

    A date whose files agree is read as a folder; only dates that mix schemas
    are read file by file, so the driver holds a path for each date (bounded
    by the calendar) and each file of mixed dates.
    """
    dates = files.groupBy(*P).agg(F.collect_set("kind").alias("kinds"))
    whole: dict[str, list[str]] = {}
    for y, m, d, kind in dates.where(F.size("kinds") == 1).select(*P, F.get("kinds", F.lit(0))).orderBy(*P).collect():
        whole.setdefault(kind, []).append(listing.date_dir(root, y, m, d))
    mixed = files.join(dates.where(F.size("kinds") > 1).select(*P), P, "left_semi")
    for path, kind in mixed.select("path", "kind").orderBy("path").collect():
        whole.setdefault(kind, []).append(path)
    return [(merged_schema([kind])[0], whole[kind]) for kind in sorted(whole)]


def read_group(spark: SparkSession, root: str, schema: StructType, paths: list[str]) -> DataFrame:
    """Rows of the paths of one group; the schema is given, so no footer is read for planning."""
    dated = StructType([*schema.fields, *[StructField(c, StringType(), True) for c in P]])
    return spark.read.schema(dated).option("basePath", root).parquet(*paths)


def rows_by_date(files: DataFrame) -> DataFrame:
    """(year, month, day, n_rows) out of the footers: the rows of every date without a scan."""
    return files.groupBy(*P).agg(F.sum("n_rows").alias("n_rows"))


# SRC-02 without DROP / MSCK
def register(spark: SparkSession, name: str, root: str, registry_root: str, database: str | None = None) -> str:
    """Crawl ``root`` and bring the catalog table up to date; the table's full name.

    A new table is created from the merged schema; a known one gets the
    columns and partitions that are new and loses the partitions that are
    gone, each in one statement.  A column that comes with several types keeps
    the type of its first appearance here; such files are read by ``groups``.
    """
    full = f"{database}.{name}" if database else name
    q = ".".join(f"`{p}`" for p in full.split("."))
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    files = crawl(spark, root, registry_root)
    schema, _ = merged_schema(kinds(files))
    ddl = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if not spark.catalog.tableExists(full):
        cols = ", ".join(filter(None, [ddl(schema.fields), *[f"`{c}` string" for c in P]]))
        spark.sql(f"CREATE TABLE {q} ({cols}) USING parquet PARTITIONED BY ({', '.join(P)}) LOCATION '{root}'")
    else:
        have = set(spark.table(full).columns)
        more = [f for f in schema.fields if f.name not in have]
        if more:
            spark.sql(f"ALTER TABLE {q} ADD COLUMNS ({ddl(more)})")
    there = {tuple(r) for r in files.select(*P).distinct().collect()}  # bounded by the calendar
    listed = {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {q}").collect()}
    for verb, dates in (("ADD IF NOT EXISTS", there - listed), ("DROP IF EXISTS", listed - there)):
        if dates:
            parts = [f"PARTITION (year='{y}', month='{m}', day='{d}')" for y, m, d in sorted(dates)]
            spark.sql(f"ALTER TABLE {q} {verb} {(' ' if verb.startswith('ADD') else ', ').join(parts)}")
    spark.catalog.refreshTable(full)
    return full
