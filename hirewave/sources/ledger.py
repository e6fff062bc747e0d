"""Record of synced dates: what each date's files were when it was last synced.

The ledger is an append-only Parquet folder with one small file for each run
(batch job or stream), written as the last step of the run: a run that dies
before it redoes its dates, which replaces the same rows.  A date is due when
the state of its raw files differs from the newest entry, so a file that lands
in a date already synced makes that date due again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.functions import rules
from hirewave.sources.listing import STATE
from hirewave.sources.partitions import latest_partition

P = rules.PARTITION_COLUMNS
SCHEMA = ("year string, month string, day string, files bigint, bytes bigint, newest timestamp, paths string, "
          "run string, at timestamp")


def entries(spark: SparkSession, root: str) -> DataFrame | None:
    """Every entry ever written, or None when nothing was synced yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def synced(spark: SparkSession, root: str) -> DataFrame | None:
    """(year, month, day, files, bytes, newest, paths) of the newest entry of every date, or None."""
    found = entries(spark, root)
    if found is None:
        return None
    last = F.max_by(F.struct(*STATE), F.struct("at", "run")).alias("_s")
    return found.groupBy(*P).agg(last).select(*P, "_s.*")


def has_run(spark: SparkSession, root: str, run: str) -> bool:
    """Whether the run's entries are written, so that a replay can be skipped."""
    found = entries(spark, root)
    return found is not None and not found.where(F.col("run") == run).limit(1).isEmpty()


def commit(states: DataFrame, root: str, run: str) -> None:
    """Write the states of the run's dates (at most the calendar's) as one file: the run's last step.

    A run without dates leaves an entry without a date, so its replay is known too.
    """
    spark = states.sparkSession
    stamp = {"run": F.lit(run), "at": F.current_timestamp()}
    rows = states.select(*P, *STATE).withColumns(stamp)
    mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[:-2]]).withColumns(stamp)
    rows.unionByName(mark).coalesce(1).write.mode("append").parquet(root)


# SRC-06 with late files
def changed_dates(states: DataFrame, done: DataFrame) -> DataFrame:
    """Dates whose raw files are not those of the ledger; both sides hold one row a date."""
    same = reduce(lambda a, b: a & b, [states[c].eqNullSafe(done[c]) for c in [*P, *STATE]])
    return states.join(done, same, "left_anti").select(*P)


def due_dates(states: DataFrame, done: DataFrame | None) -> DataFrame:
    """``changed_dates``; when there are none, the latest synced date.  Without a ledger every date is due."""
    if done is None:
        return states.select(*P)
    known = done.where("year is not null")
    left = changed_dates(states, known)
    return left.unionByName(latest_partition(known).where("year is not null").where(~left.exists()))
