"""Taxonomy by vocabulary equals the rules in place; hot skills are split."""

from pyspark.sql import functions as F

from hirewave.operators import skills, vocabulary


def test_equals_the_rules_in_place(spark):
    words = ["PySpark", "python 3", None, "", "AWS Glue", "aiaS", "java", "Rust", "PySpark"]
    df = spark.createDataFrame([(i, w, f"x{i}") for i, w in enumerate(words * 40)], "k long, hard_skills string, _note string")
    got = vocabulary.map_by_vocabulary(df)
    want = skills.map_skill(df)
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert vocabulary.map_by_vocabulary(df.limit(0)).count() == 0
    assert vocabulary.skill_vocabulary(df, "hard_skills").count() == 7


def test_lists_keep_order_nulls_and_emptiness(spark):
    lists = [["java", "PySpark", None, "java"], [], None, [None], ["aws"] * 5]
    df = spark.createDataFrame(list(enumerate(lists)), "k long, hard_skills array<string>")
    got = {r.k: r.hard_skills for r in vocabulary.map_lists_by_vocabulary(df, ["k"]).collect()}
    assert got == {r.k: r.hard_skills for r in skills.map_skills(df).collect()}


def test_a_hot_skill_is_dealt_over_many_keys(spark):
    df = spark.range(6000).select(F.when(F.col("id") < 5000, "PySpark").otherwise(F.concat(F.lit("s"), "id")).alias("hard_skills"), "id")
    joined = vocabulary.map_by_vocabulary(df)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower() and "_key" in plan and "Cartesian" not in plan
    keys = df.where("hard_skills = 'PySpark'").select(F.pmod(F.xxhash64("hard_skills", "id"), F.lit(vocabulary.SPLIT)).alias("k")).groupBy("k").count()
    assert keys.count() == vocabulary.SPLIT and keys.agg(F.max("count")).first()[0] < 5000 / 16
    assert joined.where("hard_skills = 'PySpark'").count() == skills.map_skill(df).where("hard_skills = 'PySpark'").count()
    hot = df.select(vocabulary.hot_skills(df, "hard_skills").alias("h")).first().h
    assert "PySpark" in hot and len(hot) <= vocabulary.HOT
