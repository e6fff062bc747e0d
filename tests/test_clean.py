"""Row cleaning steps on tiny frames holding the edge rows of FIXTURES.md §2."""

import datetime

from pyspark.sql import functions as F

from hirewave.operators import clean


def test_trim_only_blanks(spark):
    df = spark.createDataFrame([("  a ", "\tb\n")], "title string, company string")
    r = clean.trim_columns(df).first()
    assert r["title"] == "a" and r["company"] == "\tb\n"


def test_split_location(spark):
    rows = [("A, B",), ("Alone",), ("a, b, c",), (None,), ("",), ("x,y",)]
    df = spark.createDataFrame(rows, "location string")
    got = {r["k"]: (r["location"], r["place"], r["state"])
           for r in clean.split_location(df.withColumn("k", F.coalesce("location", F.lit("<null>")))).collect()}
    assert got["A, B"] == ("A-B", "A", "B")
    assert got["Alone"] == ("Alone", "Alone", "")
    assert got["a, b, c"] == ("a-b-c", "a,b,c", "")
    assert got["<null>"] == ("", "", "")
    assert got[""] == ("", "", "")
    assert got["x,y"] == ("x,y", "x,y", "")


def test_valid_dates(spark):
    rows = [("2024-01-03",), ("nan",), ("extract_date",), (None,), ("2024-1-3",)]
    out = clean.valid_dates(spark.createDataFrame(rows, "extract_date string")).collect()
    assert sorted(r["extract_date"] for r in out) == [datetime.date(2024, 1, 3)] * 2


def test_clean_title(spark):
    cases = {
        "Dev (Remote)": "dev ",
        "fully-remote hybrid role": "fully-  role",
        "dev $95,000/yr |remote|": "dev /yr ",
        "Data Engineer ($120,000 - $150,000)": "data engineer ",
        "QA ()": "qa ",
        "VP, Directors": "vp, directors",
    }
    df = spark.createDataFrame([(k,) for k in cases], "title string").withColumn("orig", F.col("title"))
    got = {r["orig"]: r["title"] for r in clean.clean_title(df).collect()}
    assert got == cases


def test_drop_managers_reads_title_and_drops_null(spark):
    df = spark.createDataFrame([("vp sales",), ("data engineer",), (None,), ("digital artist",)], "title string")
    assert [r["title"] for r in clean.drop_managers(df).collect()] == ["data engineer"]


def _postings(spark):
    cols = ["company", "department", "domains", "title", "extract_date", "location", "job_type", "description",
            "ORG", "ROLE", "DOMAIN", "job_url", "year", "month", "day"]
    base = ["c", "d", "w", "Dev", "2024-01-03", "A, B", "full", "desc", "o", "r", "x"]
    rows = [tuple(base + ["u/2", "2024", "01", "03"]),
            tuple(base + ["u/1", "2024", "01", "03"]),                         # same posting, smaller url
            tuple(base[:3] + ["dev"] + base[4:] + ["u/3", "2024", "01", "03"]),  # case variant stays
            tuple(base + ["u/4", "2024", "01", "04"])]                          # other date stays
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_dedup_survivor_and_scope(spark):
    out = clean.dedup_postings(_postings(spark))
    urls = sorted(r["job_url"] for r in out.collect())
    assert urls == ["u/1", "u/3", "u/4"]


def test_dedup_idempotent(spark):
    once = clean.dedup_postings(_postings(spark))
    twice = clean.dedup_postings(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_resolve_aliases(spark):
    a = spark.createDataFrame([("x", "y")], "`HARD SKILLS` string, `SOFT SKILLS` string")
    b = spark.createDataFrame([("x", "y")], "`HARD_SKILLS#0` string, `SOFT_SKILLS#1` string")
    assert clean.resolve_aliases(a).columns == ["hard_skills", "soft_skills"]
    assert clean.resolve_aliases(b).columns == ["hard_skills", "soft_skills"]
