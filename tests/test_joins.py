"""Company join and keyword lookups."""

from hirewave.operators import enrich


def test_join_companies_fan_out_and_nulls(spark):
    posts = spark.createDataFrame([("p1", "Acme"), ("p2", "Solo"), ("p3", None), ("p4", "Gone")],
                                  "job_url string, company string")
    comps = spark.createDataFrame([("Acme", "Banking"), ("Acme", "Software"), ("Solo", "Retail"),
                                   ("Gone", "Aerospace"), (None, "Banking")],
                                  "company_name string, company_industry string")
    _, kept = enrich.prepare_companies(comps)
    out = enrich.join_companies(posts, kept).collect()
    by_url = {}
    for r in out:
        by_url.setdefault(r["job_url"], []).append(r["company_industry"])
    assert sorted(by_url["p1"]) == ["Banking", "Software"]   # duplicate names fan out
    assert by_url["p3"] == [None]                             # NULL never matches
    assert by_url["p4"] == [None]                             # filtered company -> NULL columns


def test_latest_companies_partition(spark):
    comps = spark.createDataFrame([("A", "x", "2024", "01", "09"), ("B", "y", "2024", "01", "10")],
                                  "company_name string, company_industry string, year string, month string, day string")
    base, _ = enrich.prepare_companies(comps)
    assert [r["company_name"] for r in base.collect()] == ["B"]
    assert "year" not in base.columns


def test_main_title_and_department(spark):
    kws = spark.createDataFrame([("data engineer aws",), ("React.js",), ("Full Stack",), ("Plumber",), ("QC",)],
                                "keyword string")
    out = {r["keyword"]: (r["main_title"], r["department"])
           for r in enrich.add_department(enrich.add_main_title(kws)).collect()}
    assert out["data engineer aws"] == ("Data Engineer", "Data Engineering")
    assert out["React.js"] == ("FrontEnd", "Service Engineering")
    assert out["Full Stack"] == ("Full Stack", "Service Engineering")   # identity fallback
    assert out["Plumber"] == ("Plumber", None)
    assert out["QC"] == ("QC", "QC")
