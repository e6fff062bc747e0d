"""The daily raw -> silver job, end to end.

    listing of the raw folder (no file opened) -> dates whose files are not
    those of the ledger (none -> latest; no silver yet -> all) -> footers of
    new files -> one scan of exactly those dates -> silver.build -> unexploded,
    exploded (ids), validation counts -> ledger.

One Spark job per output for *all* due dates; no driver loop over dates.  The
unexploded rows are computed once and written; the exploded table and the
counts read the written files, so nothing wide is cached or checkpointed.
The raw dates are scanned once: the counts come from the footers of the raw
files and of the files just written, which an executor that is lost and
recomputed cannot count twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.functions import rules
from hirewave.operators import enrich, quality
from hirewave.plans import silver
from hirewave.session import shared_dir
from hirewave.sinks import publish, writers
from hirewave.sources import catalog, crawl, kinds, ledger, listing, partitions
from hirewave.sources import raw as raw_reads

P = rules.PARTITION_COLUMNS


@dataclass
class Outputs:
    """Where a run writes.  With ``tables`` (unexploded, exploded) the two silver
    tables are published through the catalog, else their folders are overwritten by date."""

    silver_root: str
    exploded_root: str | None
    validation_root: str | None
    tables: tuple[str, str] | None = None

    @property
    def ledger_root(self) -> str | None:
        return f"{self.validation_root.rstrip('/')}/_ledger" if self.validation_root else None

    @property
    def footers_root(self) -> str | None:
        return f"{self.validation_root.rstrip('/')}/_footers" if self.validation_root else None


def read_latest_companies(spark: SparkSession, companies_root: str) -> DataFrame:
    """Companies of the latest date, found by listing; the scan gets that one folder."""
    date = listing.latest_date(spark, companies_root)
    if date is None:
        raise ValueError(f"no companies under {companies_root}")
    return spark.read.option("basePath", companies_root).parquet(listing.date_dir(companies_root, *date)).drop(*P)


def _due(spark: SparkSession, states: DataFrame, out: Outputs) -> DataFrame:
    """Dates to redo.  A validation table older than the ledger counts as synced by its dates."""
    done = ledger.synced(spark, out.ledger_root)
    if done is not None:
        return ledger.due_dates(states, done)
    before = listing.list_dates(spark, out.validation_root)
    return partitions.remaining_dates(states, None if before.isEmpty() else before)


def sync_dates(spark: SparkSession, raw_root: str, files: DataFrame, states: DataFrame, todo: DataFrame, companies: DataFrame,
               out: Outputs, run: str, skills_mode: str = "row") -> None:
    """Redo the dates ``todo`` whole out of their ``files`` (of a listing), and commit them as ``run``.

    Order: both silver tables, the validation rows, the ledger.  Whatever
    fails before the ledger's entry makes the dates due again.
    """
    dates = [tuple(r) for r in todo.select(*P).collect()]  # bounded by the calendar
    todo = spark.createDataFrame(dates, ", ".join(f"{c} string" for c in P))
    if dates:
        crawled = None
        here = files.join(F.broadcast(todo), P, "left_semi")   # one row a date
        if out.footers_root:
            crawled = crawl.crawl(spark, raw_root, out.footers_root, here).persist(StorageLevel.MEMORY_AND_DISK)
            rows, mode = raw_reads.read_crawled(spark, raw_root, crawled, skills_mode)
        else:
            rows, mode = raw_reads.read_dates(spark, raw_root, todo, skills_mode)
        base, kept = enrich.prepare_companies(companies)
        unexploded = silver.from_prepared(rows, kept, mode)
        try:
            staged = [publish.stage(unexploded, out.tables[0], out.silver_root)] if out.tables else []
            if not staged:
                writers.replace_dates(unexploded, out.silver_root, dates)
            final = staged[0].path if staged else out.silver_root
            written = partitions.read_partitioned(spark, final, unexploded.schema).where(partitions.dates_filter(dates))
            if out.exploded_root and staged:
                staged.append(publish.stage(silver.exploded_of_table(written), out.tables[1], out.exploded_root))
            elif out.exploded_root:
                writers.replace_dates(silver.exploded_of_table(written), out.exploded_root, dates)
            if staged:
                publish.publish(spark, staged, dates)
            if out.validation_root:
                # a count that reads footers alone
                final_rows = written.groupBy(*P).agg(F.count(F.lit(1)).alias("n_rows"))
                counted = quality.funnel_rows(todo.join(crawl.rows_by_date(crawled), P, "left"), final_rows, base, kept)
                writers.write_partitioned(counted, out.validation_root, few_rows=True)
        finally:
            if crawled is not None:
                crawled.unpersist()
    if out.ledger_root:
        ledger.commit(states.join(F.broadcast(todo), P, "left_semi"), out.ledger_root, run)


def sync_silver(spark: SparkSession, raw_root: str, companies_root: str, silver_root: str,
                exploded_root: str, validation_root: str, skills_mode: str = "row",
                tables: tuple[str, str] | None = None, run: str | None = None) -> DataFrame:
    """Run the job; returns the dates that were (re)written.

    The ledger lies beside the validation rows (``_ledger``, a folder readers
    of the table skip).  It holds one row for every processed date, also for a
    date whose rows were all filtered out (and so has no silver partition).  A
    ``run`` that the ledger already holds changes nothing and returns no date.
    """
    out = Outputs(silver_root, exploded_root, validation_root, tables)
    if run is not None and ledger.has_run(spark, out.ledger_root, run):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in P))
    shared_dir(spark)                                 # the cluster's folder for the checkpoints
    files = listing.list_files(spark, raw_root)
    states = listing.date_states(files).checkpoint()
    todo = _due(spark, states, out).checkpoint()      # reused by the scan and returned
    sync_dates(spark, raw_root, files, states, todo, read_latest_companies(spark, companies_root), out, run or uuid.uuid4().hex, skills_mode)
    return todo


@dataclass
class Synced:
    """Outcome for one table of a raw database: its kind, the dates written, and what went wrong."""

    kind: str
    dates: DataFrame | None = None
    error: str | None = None


def sync_tables(spark: SparkSession, database: str, out_root: str, companies_root: str | None = None,
                skills_mode: str = "row") -> dict[str, Synced]:
    """SRC-10: the job for every table of postings in the raw ``database``; outcome by table name.

    Tables are told apart by their columns (``kinds``): postings are synced,
    companies serve the join (the one table of that kind, unless
    ``companies_root`` is given), others are left alone.  Each table of
    postings has its own ledger and outputs under ``out_root/<table>/``; one
    that fails is reported and does not stop the others.  A database that
    does not exist, or several tables of companies without ``companies_root``,
    raise.
    """
    if not catalog.database_exists(spark, database):
        raise ValueError(f"no database {database!r}")
    found = {name: kinds.kind_of(spark.table(f"`{database}`.`{name}`").columns) for name in catalog.list_tables(spark, database)}
    if companies_root is None:
        some = [name for name, kind in found.items() if kind == kinds.COMPANIES]
        if len(some) != 1:
            raise ValueError(f"companies_root is needed: the database holds {len(some)} tables of companies")
        companies_root = catalog.table_location(spark, f"{database}.{some[0]}")
    done = {}
    for name, kind in found.items():
        done[name] = Synced(kind)
        if kind != kinds.POSTINGS:
            continue
        base = f"{out_root.rstrip('/')}/{name}"
        try:
            done[name].dates = sync_silver(spark, catalog.table_location(spark, f"{database}.{name}"), companies_root, f"{base}/unexploded",
                                           f"{base}/exploded", f"{base}/validation", skills_mode)
        except Exception as e:  # reported; the other tables go on
            done[name].error = f"{type(e).__name__}: {e}"
    return done


def sync_all(spark: SparkSession, database: str, companies_root: str | None, out_root: str,
             skills_mode: str = "row") -> dict[str, DataFrame]:
    """``sync_tables`` -> dates written by name of the tables of postings; raises when one of them failed,
    after all have had their turn."""
    done = {k: v for k, v in sync_tables(spark, database, out_root, companies_root, skills_mode).items() if v.kind == kinds.POSTINGS}
    failed = {k: v.error for k, v in done.items() if v.error}
    if failed:
        raise RuntimeError("; ".join(f"{k}: {v}" for k, v in sorted(failed.items())))
    return {k: v.dates for k, v in done.items()}
