"""Sinks: date-partitioned Parquet (re-runnable), CSV, stringified Parquet.

Partitioned writes are **dynamic overwrites**: only the dates present in
the frame are replaced; ``replace_dates`` also empties requested dates that
have no rows any more, so re-running a date gives the same table.  Rows are
rebalanced by date before the write, without sampling the input first: an
ordinary date lands in one task (one file), while AQE splits a date that
holds a large share of the rows over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewave.functions import rules
from hirewave.session import shared_dir

P = rules.PARTITION_COLUMNS


def _spread(df: DataFrame) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in P])


def spread_dates(df: DataFrame) -> DataFrame:
    """For a frame of few rows a date: its dates over all tasks, where a rebalance by size would leave them to one."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *P)


# SNK-01 / SNK-05 / SNK-06
def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite", few_rows: bool = False) -> None:
    """``few_rows``: a bounded number of rows a date, so that dates, not bytes, are what the tasks share."""
    ((spread_dates if few_rows else _spread)(df).write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*P)
        .parquet(path))


def write_single(df: DataFrame, path: str) -> tuple[str, str, str]:
    """Write rows of one date into its folder; the date.  A frame of no or several dates raises before anything is written."""
    from hirewave.sources import listing, partitions

    date = partitions.single_partition(df)
    df.drop(*P).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(listing.date_dir(path, *date))
    return date


def replace_dates(df: DataFrame, path: str, dates: list[tuple[str, str, str]]) -> None:
    """Write ``df`` and empty those of ``dates`` (bounded by the calendar) that it has no rows for.

    What was written is found by listing the files before and after: a date
    keeps a file of the time before only where the write did not touch it.
    """
    from hirewave.sources import listing

    spark = df.sparkSession
    shared_dir(spark)
    before = listing.list_files(spark, path, dates).checkpoint()
    write_partitioned(df, path)
    kept = before.join(listing.list_files(spark, path, dates).select("path"), "path", "left_semi")
    for y, m, d in sorted(tuple(r) for r in kept.select(*P).distinct().collect()):
        (df.drop(*P).limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static")
           .parquet(f"{path.rstrip('/')}/year={y}/month={m}/day={d}"))


def save_table(df: DataFrame, path: str, table: str | None = None) -> None:
    """SNK-01: write by date (dynamic overwrite) and refresh the catalog table."""
    write_partitioned(df, path)
    if table:
        from hirewave.sources import listing

        spark = df.sparkSession
        if spark.catalog.tableExists(table):
            name = ".".join(f"`{x}`" for x in table.split("."))
            dates = [tuple(r) for r in listing.list_dates(spark, path).collect()]  # bounded by the calendar
            parts = " ".join(f"PARTITION (year='{y}', month='{m}', day='{d}')" for y, m, d in dates)
            if parts:
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
            spark.catalog.refreshTable(table)
        else:
            from hirewave.sources.catalog import register_table
            register_table(spark, table, path)


# SNK-07
def partition_columns(date_col: Column) -> dict[str, Column]:
    """Zero-padded year / month / day strings of a date or timestamp."""
    return {"year": F.date_format(date_col, "yyyy"), "month": F.date_format(date_col, "MM"),
            "day": F.date_format(date_col, "dd")}


def land_raw(df: DataFrame, root: str, run_date: Column | None = None) -> None:
    """SNK-05: land rows under root/year=/month=/day= (from ``run_date`` when the
    frame has no partition columns yet)."""
    if not all(c in df.columns for c in P):
        df = df.withColumns(partition_columns(run_date if run_date is not None else F.current_date()))
    write_partitioned(df, root)


# SNK-02
def stringify_all(df: DataFrame, null_token: str | None = None) -> DataFrame:
    """Every column cast to string.  NULL stays NULL unless ``null_token``
    (e.g. 'nan', as the original writer produced) is given.  Arrays of text
    are printed as quoted lists, the form the skills parser reads back."""
    cols = []
    for c, kind in df.dtypes:
        s = F.col(c).cast("string")
        if kind == "array<string>":
            quoted = F.transform(F.col(c), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
            s = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
        cols.append((F.coalesce(s, F.lit(null_token)) if null_token is not None else s).alias(c))
    return df.select(*cols)


# SNK-03 / SNK-04
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line per part file; NULL written as \\N so '' survives,
    surrounding blanks kept (the CSV writer trims them by default)."""
    (df.write.mode(mode).option("header", True).option("nullValue", CSV_NULL)
       .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))


def append_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, mode="append")


def read_csv(spark, path: str, schema=None):
    r = (spark.read.option("header", True).option("multiLine", True)
         .option("nullValue", CSV_NULL).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)
