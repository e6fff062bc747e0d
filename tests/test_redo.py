"""Redone dates, pruned scans, and inputs that used to lose or multiply rows."""

import os

import pytest
from pyspark.sql import functions as F

from hirewave import fixtures
from hirewave.operators import clean, enrich, harvest, skills
from hirewave.plans import jobs
from hirewave.sinks import writers
from hirewave.sources import partitions

SF = "/root/testdata/sf0.001"
P = ["year", "month", "day"]


def _landed(spark, tmp_dir, n=3):
    p = fixtures.postings(spark, SF)
    dates = [tuple(r) for r in p.select(*P).distinct().orderBy(*P).limit(n).collect()]
    raw, companies = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "companies")
    rows = p.where(partitions.dates_filter(dates)).cache()
    writers.write_partitioned(rows, raw)
    writers.write_partitioned(fixtures.companies(spark, SF).selectExpr("*", "'2024' as year", "'01' as month", "'03' as day"), companies)
    return rows, dates, raw, companies


def test_scan_reads_only_the_requested_dates(spark, tmp_dir):
    rows, dates, raw, _ = _landed(spark, tmp_dir)
    want = spark.createDataFrame(dates[:1], P)
    for scan in (partitions.scan_dates(spark, raw, want), partitions.scan_dates(spark, raw, want, merge_schema=True)):
        assert {f.split("/year=")[1].rpartition("/")[0] for f in (r[0] for r in scan.select(F.input_file_name()).distinct().collect())} == {
            "{}/month={}/day={}".format(*dates[0])}
        assert scan.count() == rows.where(partitions.dates_filter(dates[:1])).count()
        plan = scan._jdf.queryExecution().executedPlan().toString()
        assert "DynamicPruning" not in plan
    assert partitions.scan_dates(spark, raw, want.limit(0)).count() == 0


def test_a_redone_date_without_rows_leaves_none_behind(spark, tmp_dir):
    rows, dates, raw, companies = _landed(spark, tmp_dir, 2)
    out, exp, val = (os.path.join(tmp_dir, n) for n in ("silver", "exploded", "validation"))
    jobs.sync_silver(spark, raw, companies, out, exp, val)
    last = dates[-1]
    before = partitions.read_partitioned(spark, out).where(partitions.dates_filter(dates[:1])).count()
    gone = rows.where(partitions.dates_filter([last])).withColumn("extract_date", F.lit("no date"))
    writers.write_partitioned(gone, raw)
    assert [tuple(r) for r in jobs.sync_silver(spark, raw, companies, out, exp, val).collect()] == [last]
    for root in (out, exp):
        assert partitions.read_partitioned(spark, root).where(partitions.dates_filter([last])).count() == 0
    assert partitions.read_partitioned(spark, out).where(partitions.dates_filter(dates[:1])).count() == before


def test_companies_of_one_name_do_not_multiply_postings(spark):
    c = spark.createDataFrame([("a", "2", "x"), ("a", "1", "z"), ("b", None, "y"), (None, "1", "q")], "company_name string, size string, company_industry string")
    assert sorted(tuple(r) for r in enrich.one_per_name(c).collect()) == [("a", "1", "z"), ("b", None, "y")]


def test_missing_keys_and_sniff_over_two_spellings_raise(spark):
    with pytest.raises(ValueError):
        clean.dedup_postings(spark.createDataFrame([("a",)], "job_title string"))
    two = spark.createDataFrame([("x", None)], "`HARD SKILLS` string, hard_skills string")
    if len(clean.skill_variants(two)) > 1:
        with pytest.raises(ValueError):
            skills.parse_skills(two, mode="sniff")


def test_facet_plan_shows_what_is_beyond_the_cap(spark):
    df = spark.range(25).selectExpr("'k' as keyword", "'1' as experience", "'2' as work_type")
    row = harvest.facet_plan(df, cap=10).first()
    assert (row.total, row.overflow) == (25, 15)
    assert harvest.facet_plan(df, cap=10, cut=True).first().total == 10


def test_printed_arrays_parse_back(spark):
    df = spark.createDataFrame([(["x y", "z"],), ([],), (None,)], "s array<string>")
    printed = writers.stringify_all(df)
    assert [r.s for r in printed.collect()] == ["['x y', 'z']", "[]", None]
    assert printed.select(skills.parse_comma(F.col("s")).alias("p")).first().p == ["x y", "z"]
