"""The daily job end to end: first run writes all dates, a re-run redoes only the
latest, and the tables equal the batch plans."""

import os

import pytest
from pyspark.sql import functions as F

from hirewave import fixtures
from hirewave.plans import jobs, silver
from hirewave.sinks import writers
from hirewave.sources import catalog, partitions

SF = "/root/testdata/sf0.001"


@pytest.mark.slow
def test_sync_silver_twice(spark, tmp_dir):
    p = fixtures.postings(spark, SF)
    comp = fixtures.companies(spark, SF).selectExpr("*", "'2024' as year", "'01' as month", "'03' as day")
    raw, cpath = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "companies")
    out, exp, val = (os.path.join(tmp_dir, n) for n in ("silver", "exploded", "validation"))
    writers.write_partitioned(p, raw)
    writers.write_partitioned(comp, cpath)
    first = jobs.sync_silver(spark, raw, cpath, out, exp, val)
    n_dates = p.select("year", "month", "day").distinct().count()
    assert first.count() == n_dates
    again = jobs.sync_silver(spark, raw, cpath, out, exp, val)
    assert again.count() == 1                                   # nothing new: latest date redone
    got = partitions.read_partitioned(spark, out)
    want = silver.silver_unexploded(p, fixtures.companies(spark, SF))
    assert got.count() == want.count()
    ids = partitions.read_partitioned(spark, exp)
    assert ids.count() == silver.silver_exploded(want).count()
    assert partitions.read_partitioned(spark, val).count() == n_dates


@pytest.mark.slow
def test_sync_touches_only_new_date(spark, tmp_dir):
    p = fixtures.postings(spark, SF)
    comp = fixtures.companies(spark, SF).selectExpr("*", "'2024' as year", "'01' as month", "'03' as day")
    raw, cpath = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "companies")
    out, exp, val = (os.path.join(tmp_dir, n) for n in ("silver", "exploded", "validation"))
    dates = [tuple(r) for r in p.select("year", "month", "day").distinct().orderBy("year", "month", "day").collect()]
    first_two, third = dates[:2], dates[2]
    cond = " or ".join(f"(year = '{y}' and month = '{m}' and day = '{d}')" for y, m, d in first_two)
    writers.write_partitioned(comp, cpath)
    writers.write_partitioned(p.where(cond), raw)
    assert sorted(tuple(r) for r in jobs.sync_silver(spark, raw, cpath, out, exp, val).collect()) == first_two
    y, m, d = third
    writers.write_partitioned(p.where(f"year = '{y}' and month = '{m}' and day = '{d}'"), raw, mode="append")
    touched = [tuple(r) for r in jobs.sync_silver(spark, raw, cpath, out, exp, val).collect()]
    assert touched == [third]
    assert partitions.read_partitioned(spark, val).count() == 3


@pytest.mark.slow
def test_sync_all_tables_of_a_database(spark, tmp_dir):
    p = fixtures.postings(spark, SF)
    comp = fixtures.companies(spark, SF).selectExpr("*", "'2024' as year", "'01' as month", "'03' as day")
    cpath, out = os.path.join(tmp_dir, "companies"), os.path.join(tmp_dir, "out")
    writers.write_partitioned(comp, cpath)
    dates = [tuple(r) for r in p.select("year", "month", "day").distinct().orderBy("year", "month", "day").limit(3).collect()]
    wanted = {"board_a": dates[:2], "board_b": dates[2:]}
    try:
        for name, some in wanted.items():
            root = os.path.join(tmp_dir, name)
            writers.write_partitioned(p.where(partitions.dates_filter(some)), root)
            catalog.register_table(spark, name, root, database="raw_boards")
        done = jobs.sync_all(spark, "raw_boards", cpath, out)
        assert {k: sorted(map(tuple, d.collect())) for k, d in done.items()} == wanted
        for name, some in wanted.items():
            got = partitions.read_partitioned(spark, f"{out}/{name}/unexploded")
            want = silver.silver_unexploded(p.where(partitions.dates_filter(some)), fixtures.companies(spark, SF))
            assert got.count() == want.count() > 0
        with pytest.raises(ValueError, match="no_such"):
            jobs.sync_all(spark, "no_such", cpath, out)
    finally:
        spark.sql("DROP DATABASE IF EXISTS raw_boards CASCADE")


@pytest.mark.slow
def test_validation_table_has_a_row_for_every_day(spark):
    from hirewave.plans.queries_io import q_validation_table

    days = fixtures.postings(spark, SF).select("year", "month", "day").distinct()
    got = q_validation_table(spark, SF).select("year", "month", "day")
    assert got.count() == days.count() and got.exceptAll(days).count() == 0 and days.select("day").distinct().count() > 1


def test_few_rows_a_date_are_written_by_many_tasks(spark, tmp_dir):
    import glob

    rows = spark.range(64).selectExpr("'2024' as year", "'01' as month", "cast(id as string) as day", "id as n")
    writers.write_partitioned(rows, f"{tmp_dir}/t", few_rows=True)
    tasks = {os.path.basename(f).split("-")[1] for f in glob.glob(f"{tmp_dir}/t/year=*/month=*/day=*/*.parquet")}
    assert len(tasks) > 1 and partitions.read_partitioned(spark, f"{tmp_dir}/t").count() == 64


@pytest.mark.slow
def test_roundtrip_saves_one_built_frame_twice(spark, monkeypatch):
    from hirewave.plans.queries_io import q_silver_roundtrip

    saved, save = [], writers.save_table
    monkeypatch.setattr(writers, "save_table", lambda df, *a, **k: (saved.append((df, df.storageLevel.useDisk)), save(df, *a, **k)))
    assert q_silver_roundtrip(spark, SF).count() > 0
    assert len(saved) == 2 and saved[0][0] is saved[1][0] and all(kept for _, kept in saved)
    assert not saved[0][0].storageLevel.useDisk


@pytest.mark.slow
def test_republish_explodes_the_rows_it_wrote(spark, monkeypatch):
    from hirewave.plans.queries_io import q_silver_republish

    given, explode = [], silver.silver_exploded
    monkeypatch.setattr(silver, "silver_exploded", lambda u: (given.append(u), explode(u))[1])
    q_silver_republish(spark, SF)
    plans = [u._jdf.queryExecution().optimizedPlan().toString() for u in given]
    assert len(plans) == 2 and not any("Join" in p or "Aggregate" in p for p in plans)
    built = silver.silver_unexploded(fixtures.monthly_postings(spark, SF), fixtures.companies(spark, SF))
    assert given[1].dtypes == built.dtypes and given[1].exceptAll(built).count() == 0 and given[1].count() == built.count()


def test_silver_labels_verticals_by_company_and_lowers_a_skill_once(spark):
    one = fixtures.postings(spark, SF).limit(3).withColumns({"company": F.expr("case when rid % 2 = 0 then 'A' end"), "title": F.lit("data engineer")})
    companies = spark.createDataFrame([("A", "Banking"), ("B", None), (None, "Software")], "company_name string, company_industry string")
    got = silver.silver_unexploded(one, companies)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join, rule = plan.index("Join LeftOuter"), "Insurance|Life Science"
    assert plan.count(rule) >= 1 and rule not in plan[:join]
    assert plan.count("lower(") < 10
    assert {(r.company, r.verticals) for r in got.collect()} <= {("A", "BFS_EDU_GOV"), (None, "None")}
