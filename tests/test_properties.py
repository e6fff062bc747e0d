"""Properties from the test strategy: date-split runs, both skill paths, explode inverse."""

from pyspark.sql import functions as F

from hirewave import fixtures
from hirewave.operators import clean, skills
from hirewave.plans import silver

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_dates_one_by_one_equal_all_at_once(spark):
    p = fixtures.postings(spark, SF)
    comp = fixtures.companies(spark, SF)
    whole = silver.silver_unexploded(p, comp)
    early = silver.silver_unexploded(p.where("year < '1998'"), comp)
    late = silver.silver_unexploded(p.where("year >= '1998'"), comp)
    assert _rows(whole) == _rows(early.unionByName(late))


def test_both_skill_paths_equal(spark):
    parsed = skills.parse_skills(clean.clean_rows(fixtures.postings(spark, SF)))
    via_transform = skills.explode_skills(skills.map_skills(parsed)).select("job_url", "skill_pos", "hard_skills")
    via_scalar = skills.map_skill(skills.explode_skills(parsed)).select("job_url", "skill_pos", "hard_skills")
    assert _rows(via_transform) == _rows(via_scalar)


def test_explode_then_collect_gives_non_empty_arrays(spark):
    parsed = skills.parse_skills(clean.clean_rows(fixtures.postings(spark, SF))).select("job_url", "hard_skills")
    back = (skills.explode_skills(parsed)
            .groupBy("job_url")
            .agg(F.sort_array(F.collect_list(F.struct("skill_pos", "hard_skills"))).alias("s"))
            .select("job_url", F.col("s.hard_skills").alias("hard_skills")))
    want = parsed.where(F.size("hard_skills") > 0)
    assert _rows(back) == _rows(want)
