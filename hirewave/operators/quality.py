"""Row-count checks: grouped counts for all dates in one job, no driver loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirewave.functions import rules

P = rules.PARTITION_COLUMNS


# VAL-01
def department_counts(df: DataFrame) -> DataFrame:
    """COUNT(*) by department, extract_date, year, month, day (partial agg + one shuffle)."""
    return (df.groupBy("department", "extract_date", *P)
              .agg(F.count(F.lit(1)).alias("record_count")))


def counts_by_date(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*P).agg(F.count(F.lit(1)).alias(name))


# VAL-03
def stamp_date(df: DataFrame) -> DataFrame:
    """Date = cast(concat_ws('-', year, month, day) as date)."""
    return df.withColumn("Date", F.concat_ws("-", *P).cast("date"))


# VAL-02 + VAL-03
def funnel_rows(scraped: DataFrame, final: DataFrame, companies: DataFrame, companies_kept: DataFrame) -> DataFrame:
    """One validation row per date of ``scraped`` (year, month, day, n_rows), out of counts by date.

    ``final`` has the rows that are left, by date; a date without any gets 0.
    The two company counts are the same for every date; they enter as scalar
    subqueries (computed once, no cross join).
    """
    first, last, total, kept = rules.COUNT_COLUMNS
    # both sides hold one row per date (bounded by the calendar)
    out = (scraped.withColumnRenamed("n_rows", first).join(F.broadcast(final.withColumnRenamed("n_rows", last)), P, "left")
           .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in (first, last)})
           .withColumn(total, companies.select(F.count(F.lit(1))).scalar())
           .withColumn(kept, companies_kept.select(F.count(F.lit(1))).scalar()))
    return stamp_date(out)


def funnel_counts(raw: DataFrame, companies: DataFrame, companies_kept: DataFrame,
                  final: DataFrame) -> DataFrame:
    """One validation row per date: scraped rows, companies, kept companies, final rows.

    Per-date counts are partial aggregates joined on (year, month, day); dates
    whose rows were all filtered out still get a row with 0.
    """
    return funnel_rows(counts_by_date(raw, "n_rows"), counts_by_date(final, "n_rows"), companies, companies_kept)


# VAL-03 standalone: stamp literal (year, month, day) on a one-row count frame
def validation_row(counts: DataFrame, year: str, month: str, day: str) -> DataFrame:
    return stamp_date(counts.withColumns({"year": F.lit(year), "month": F.lit(month), "day": F.lit(day)}))
