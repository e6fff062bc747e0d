"""Joins: companies onto postings, keyword -> main title -> department lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.functions import rules
from hirewave.operators import clean


def latest_companies(companies: DataFrame) -> DataFrame:
    """Companies of the latest (year, month, day) partition, when partitioned.

    The latest key is a one-row aggregate used as a scalar subquery, so the
    partition filter is evaluated once (and prunes when the source is
    partitioned on disk).
    """
    if not all(c in companies.columns for c in rules.PARTITION_COLUMNS):
        return companies
    # 'y/m/d' with '/' (below every digit) orders exactly like the (y, m, d)
    # tuple, so one scalar subquery gives the latest key; as a filter on
    # partition columns it prunes directories at run time.
    key = F.concat_ws("/", *rules.PARTITION_COLUMNS)
    latest = companies.select(F.max(key)).scalar()
    return companies.where(key == latest)


def prepare_companies(companies: DataFrame, ignore_case: bool = False) -> tuple[DataFrame, DataFrame]:
    """-> (companies without date/url columns, companies after the industry filter)."""
    base = latest_companies(companies)
    drop = [c for c in rules.COMPANY_DROP_COLUMNS if c in base.columns]
    base = base.drop(*drop)
    if "company size" in base.columns:
        base = base.withColumnRenamed("company size", "company_size")
    return base, clean.drop_industries(base, ignore_case)


def one_per_name(companies: DataFrame) -> DataFrame:
    """One row per company name: the smallest by the other columns, in order.

    Silver holds one row per posting, so a name that several companies share
    must not multiply its postings.
    """
    rest = [c for c in companies.columns if c != "company_name"]
    low = companies.where("company_name is not null").groupBy("company_name").agg(F.min(F.struct(*rest)).alias("_c"))
    return low.select(*[F.col(c) if c == "company_name" else F.col(f"_c.`{c}`").alias(c) for c in companies.columns])


# JON-01
def join_companies(postings: DataFrame, companies_kept: DataFrame) -> DataFrame:
    """Postings LEFT JOIN companies on company = company_name.

    No broadcast hint: the companies table grows with the data.  The
    optimizer broadcasts it only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time with
    the real size); above that it is a sort-merge join whose hot company
    keys AQE splits (skew join on the postings side).  Duplicate company
    names fan out; NULL keys never match.
    """
    return postings.join(companies_kept, postings["company"] == companies_kept["company_name"], "left")


# JON-02 / JON-03 lookup tables: fixed, a few dozen rows -> broadcast is bounded
def title_lookup(spark: SparkSession) -> DataFrame:
    seen: dict[str, tuple[int, str]] = {}
    for prio, (main, keywords) in enumerate(rules.TITLE_MAPPING):
        for kw in keywords:
            seen.setdefault(kw.lower(), (prio, main))
    rows = [(k, p, m) for k, (p, m) in seen.items()]
    return spark.createDataFrame(rows, "kw_lower string, title_priority int, main_title string")


def department_lookup(spark: SparkSession) -> DataFrame:
    seen: dict[str, tuple[int, str]] = {}
    for prio, (dept, titles) in enumerate(rules.DEPARTMENT_MAPPING):
        for t in titles:
            seen.setdefault(t.lower(), (prio, dept))
    rows = [(k, p, d) for k, (p, d) in seen.items()]
    return spark.createDataFrame(rows, "title_lower string, dept_priority int, department string")


def add_main_title(df: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """Case-insensitive keyword lookup; no hit keeps the keyword itself."""
    lk = F.broadcast(title_lookup(df.sparkSession))
    out = df.join(lk, F.lower(df[keyword_col]) == lk["kw_lower"], "left")
    return out.withColumn("main_title", F.coalesce(F.col("main_title"), df[keyword_col])).drop(
        "kw_lower", "title_priority")


def add_department(df: DataFrame, title_col: str = "main_title") -> DataFrame:
    """Case-insensitive main title lookup; no hit gives NULL."""
    lk = F.broadcast(department_lookup(df.sparkSession))
    out = df.join(lk, F.lower(df[title_col]) == lk["title_lower"], "left")
    return out.drop("title_lower", "dept_priority")
