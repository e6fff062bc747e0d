"""Every rule has a hit; shadowed rules name their winner; dead rules stay dead."""

from pyspark.sql import functions as F

from hirewave.functions import exprs, rules


def _apply(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return {r["x"]: r["y"] for r in df.select("x", fn(F.col("x")).alias("y")).collect()}


TITLE_CASES = {
    "senior back end engineer": "Backend Developer",
    "ui and ux lead": "UI/UX Developer",
    "data analyst ii": "Data Analyst",
    "senior web designer": "Web Designer",
    "web designer intern": "web designer intern",          # '%web%designer' must end the title
    "asp.net dev": ".Net Developer",
    "azure data engineer": "Azure Data Engineer",
    "aws cloud data engineer": "AWS Data Engineer",
    "data engineer": "Data Engineer",
    "qa tester": "Quality Assurance",
    "react js developer": "React JS Developer",
    "frontend developer": "Frontend Developer",
    "full stack developer": "Full Stack Developer",
    "security analyst": "IT Analyst",                      # '%it%analyst%' catches 'security'
    "etl developer": "ETL Developer",
    "nurse practitioner": "Nurse",
    "c++ developer": "C++ Developer",
    "plumber": "plumber",
    "digital marketing lead": "Digital Marketing",
    "marketing lead": "Marketing",
    "machine learning engineer": "Machine Learning Engineer",
    "devops engineer": "DevOps Engineer",
}


def test_title_rules(spark):
    got = _apply(spark, list(TITLE_CASES), exprs.title_taxonomy)
    assert got == TITLE_CASES


def test_every_title_rule_reachable(spark):
    # each rule's first pattern with wildcards blanked is won by that rule or an earlier one
    samples = {p.replace("%", " ").strip() or "x": label for label, ps in rules.TITLE_RULES for p in ps[:1]}
    got = _apply(spark, list(samples), exprs.title_taxonomy)
    labels = [label for label, _ in rules.TITLE_RULES]
    for s, label in samples.items():
        assert labels.index(got[s]) <= labels.index(label), (s, got[s])


SKILL_CASES = {
    "PySpark": "Apache Spark",
    "Python 3": "Python",
    "JavaScript": "Javascript",
    "Java": "Java",
    "AWS Glue": "AWS Glue",
    "aws cloud services": "AWS Services",
    "aws": "AWS Services",
    "PostgreSQL": "PostgreSQL",
    "Azure Data Factory": "Azure Data Factory",
    "REST API": "REST API",            # 'API%' is case-sensitive and anchored at the start
    "API design": "API",
    "api design": "api design",
    "netlify": "ETL",                  # 'netlify' contains 'etl'
    "Power BI": "Power BI",
    "llm tuning": "Large Language Model (LLM)",
    "git": "GIT",
    "Git": "GIT",
    "github": "github",
    "Excel": "Excel",
    "net": ".NET",
    "ab testing": "A/B Testing",
    "AIaaS": "AIaaS",                  # unchanged: the 'aiaS' rule is dead
}


def test_skill_rules(spark):
    got = _apply(spark, list(SKILL_CASES), exprs.skill_taxonomy)
    assert got == SKILL_CASES


def test_dead_skill_rule(spark):
    got = _apply(spark, ["aias", "AIAS", "aiaS"], exprs.skill_taxonomy)
    assert all(v != "AIaaS" for v in got.values())


def test_verticals(spark):
    cases = {
        "Oil and Gas": "PR",
        "Soil Science": "PR",                       # substring 'Oil'
        "Hospitals and Health Care": "HC_INCS_LS",  # listed twice, HC wins
        "Software Development": "CMT",
        "Banking": "BFS_EDU_GOV",
        "Restaurants": "None",
        "insurance": "HC_INCS_LS",                  # case-insensitive
    }
    got = _apply(spark, list(cases), exprs.verticals)
    assert got == cases
    nulls = spark.createDataFrame([(None,)], "x string").select(exprs.verticals(F.col("x")).alias("y")).first()
    assert nulls["y"] == "None"


def test_manager_and_industry_words(spark):
    df = spark.createDataFrame([("VP Engineering",), ("Director of IT",), ("data engineer",), ("BusinessAnalyst",),
                                ("vpn engineer",), (None,)], "x string")
    kept = [r["x"] for r in df.where(~exprs.manager_title(F.col("x"))).collect()]
    assert kept == ["data engineer"]        # 'vpn' holds 'vp'; NULL is dropped
    ind = spark.createDataFrame([("Aerospace",), ("Robotics",), ("robotics",), ("Banking",), (None,)], "x string")
    kept = sorted(r["x"] for r in ind.where(~exprs.dropped_industry(F.col("x"))).collect())
    assert kept == ["Banking", "Robotics"]  # case-sensitive: 'Robotics' stays, 'Aerospace' has 'space'
    kept_ci = sorted(r["x"] for r in ind.where(~exprs.dropped_industry(F.col("x"), True)).collect())
    assert kept_ci == ["Banking"]
