"""Ids of list entries by two narrow passes over written rows."""

import os

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirewave.operators import ids, skills

GROUP = ["year", "month", "day"]


def written(spark, tmp_dir, rows):
    path = os.path.join(tmp_dir, "rows")
    spark.createDataFrame(rows, "job_url string, note string, hard_skills array<string>, year string, month string, day string").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def test_ids_equal_row_number(spark, tmp_dir):
    rows = [(f"u{i:04}", "x", [f"s{k}" for k in range(i % 5)] if i % 7 else None, "2024", "01", "03" if i % 3 else "04") for i in range(600)]
    rows += [(None, "null url", ["a", None], "2024", "01", "03"), ("v", "null date", ["a"], None, "01", "03")]
    df = written(spark, tmp_dir, rows)
    got = ids.list_ids(df, GROUP, ["job_url"], "hard_skills")
    want = skills.explode_skills(df).withColumn("id", F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.col("job_url").asc_nulls_first(), "skill_pos")))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_equal_rows_have_ids_of_their_own(spark, tmp_dir):
    df = written(spark, tmp_dir, [("same", "x", ["a", "b"], "2024", "01", "03")] * 300 + [("other", "x", ["c"], "2024", "01", "03")])
    got = ids.list_ids(df, GROUP, ["job_url"], "hard_skills").collect()
    assert sorted(r.id for r in got) == list(range(1, 602))
    assert [r.hard_skills for r in sorted(got, key=lambda r: r.id)] == ["c"] + ["a", "b"] * 300
    assert ids.list_ids(df.where("job_url = 'none'"), GROUP, ["job_url"], "hard_skills").count() == 0


def test_only_narrow_rows_are_put_in_order(spark, tmp_dir):
    df = written(spark, tmp_dir, [(f"u{i}", "x", ["a"], "2024", "01", "03") for i in range(20)])
    plan = ids.list_ids(df, GROUP, ["job_url"], "hard_skills")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "InMemoryTableScan" not in plan
