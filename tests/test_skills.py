"""Skill parsing (both printed forms, arrays, sniff), explode and contiguous ids."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirewave.operators import ids, skills

Q = "'"


def _parse(spark, values, mode="row"):
    rows = [(i, v, "2024", "01", "03") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, hard_skills string, year string, month string, day string")
    return [r["hard_skills"] for r in skills.parse_skills(df, mode=mode).orderBy("i").collect()]


def test_comma_form(spark):
    assert _parse(spark, ["['a', 'b', 'a']"], "comma") == [["a", "b"]]


def test_space_form_with_newline_keeps_duplicates(spark):
    assert _parse(spark, ["['a' 'b'\n 'a']"], "space") == [["a", "b", "a"]]


def test_edge_strings(spark):
    got = _parse(spark, ["['one']", "[]", "nan", '["dq", "x"]', None])
    assert got[0] == ["one"]
    assert got[1] == ["[]"]
    assert got[2] == ["nan"]
    assert got[3] == ['["dq", "x"]']
    assert got[4] is None


def test_mixed_batch_per_row(spark):
    got = _parse(spark, ["['a', 'b']", "['c' 'd'\n 'e']"])
    assert got == [["a", "b"], ["c", "d", "e"]]


def test_true_array_dedup_and_sibling_cast(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["o1", "o2"])], "hard_skills array<string>, ORG array<string>")
    r = skills.parse_skills(df).first()
    assert r["hard_skills"] == ["a", "b"] and r["ORG"] == "[o1, o2]"


def test_sniff_per_date(spark):
    rows = [("['a' 'b']", "2024", "01", "03"), ("['z', 'y']", "2024", "01", "03"),
            ("['a', 'b']", "2024", "01", "04"), (None, "2024", "01", "05"), ("['q' 'r']", "2024", "01", "05")]
    df = spark.createDataFrame(rows, "hard_skills string, year string, month string, day string")
    fmt = {r["day"]: r["skills_format"] for r in skills.sniff_format(df).collect()}
    assert fmt == {"03": "space", "04": "comma", "05": "comma"}   # a NULL sorts first -> comma


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, hard_skills array<string>")
    out = skills.explode_skills(df).collect()
    assert [(r["k"], r["skill_pos"], r["hard_skills"]) for r in out] == [(1, 0, "a"), (1, 1, "b")]
    assert out[0]["hard_skills_array"] == ["a", "b"]


def test_sequence_ids_equal_row_number(spark):
    # one hot date with most rows, spread over several range partitions
    rows = [("2024", "01", "03" if i % 10 else "04", f"u{i:05d}", i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "year string, month string, day string, job_url string, skill_pos int")
    got = ids.sequence_ids(df, ["year", "month", "day"], ["job_url", "skill_pos"], num_partitions=7)
    w = Window.partitionBy("year", "month", "day").orderBy("job_url", "skill_pos")
    want = df.withColumn("id", F.row_number().over(w).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())
    per_date = {r["day"]: (r["lo"], r["hi"], r["n"]) for r in
                got.groupBy("day").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                                       F.count(F.lit(1)).alias("n")).collect()}
    assert all(lo == 1 and hi == n for lo, hi, n in per_date.values())


def test_map_skills_in_place(spark):
    df = spark.createDataFrame([(["PySpark", "Excel"],)], "hard_skills array<string>")
    assert skills.map_skills(df).first()["hard_skills"] == ["Apache Spark", "Excel"]


def test_mixed_producers_in_one_scan(spark, tmp_dir):
    """Dates written by both producers (other column name, string vs array) read
    with one mergeSchema scan and parsed into one hard_skills column."""
    import os

    from hirewave.operators import clean
    from hirewave.sinks import writers
    from hirewave.sources import partitions
    root = os.path.join(tmp_dir, "raw")
    a = spark.createDataFrame([("u1", "['x', 'y', 'x']", "2024", "01", "03"),
                               ("u2", "['p' 'q'\n 'p']", "2024", "01", "03")],
                              "job_url string, `HARD SKILLS` string, year string, month string, day string")
    b = spark.createDataFrame([("u3", ["m", "n", "m"], "2024", "01", "04")],
                              "job_url string, `HARD_SKILLS#0` array<string>, year string, month string, day string")
    writers.write_partitioned(a, root)
    writers.write_partitioned(b, root, mode="append")
    raw = partitions.read_partitioned(spark, root, merge_schema=True)
    out = skills.parse_skills(clean.resolve_aliases(raw))
    got = {r["job_url"]: r["hard_skills"] for r in out.collect()}
    assert got == {"u1": ["x", "y"], "u2": ["p", "q", "p"], "u3": ["m", "n"]}
    assert "HARD SKILLS" not in out.columns and "HARD_SKILLS#0" not in out.columns


def test_same_name_different_types_fallback(spark, tmp_dir):
    """One date wrote hard_skills as printed text, another as a true array:
    Parquet cannot merge them, so the dates are read per file schema."""
    import os

    from hirewave.sinks import writers
    from hirewave.sources import raw as raw_reads
    root = os.path.join(tmp_dir, "raw")
    a = spark.createDataFrame([("u1", "['x', 'y', 'x']", "2024", "01", "03"),
                               ("u2", "['p' 'q'\n 'p']", "2024", "01", "03")],
                              "job_url string, hard_skills string, year string, month string, day string")
    b = spark.createDataFrame([("u3", ["m", "n", "m"], ["o"], "2024", "01", "04")],
                              "job_url string, hard_skills array<string>, ORG array<string>, "
                              "year string, month string, day string")
    writers.write_partitioned(a, root)
    writers.write_partitioned(b, root, mode="append")
    dates = spark.createDataFrame([("2024", "01", "03"), ("2024", "01", "04")], "year string, month string, day string")
    rows, mode = raw_reads.read_dates(spark, root, dates)
    assert mode == "parsed"
    got = {r["job_url"]: (r["hard_skills"], r["ORG"]) for r in rows.collect()}
    assert got == {"u1": (["x", "y"], None), "u2": (["p", "q", "p"], None), "u3": (["m", "n"], "[o]")}
    assert skills.parse_skills(rows, mode=mode).collect() == rows.collect()


def test_files_of_one_date_keep_their_own_spelling_and_type(spark, tmp_dir):
    import os

    import pytest

    from hirewave.sinks import writers
    from hirewave.sources import raw as raw_reads
    root, date = os.path.join(tmp_dir, "raw"), ("2024", "01", "03")
    tail = "year string, month string, day string"
    for rows, kind in (([("u1", "['x', 'y']", *date)], "job_url string, hard_skills string, "),
                       ([("u2", "['p', 'q']", *date)], "job_url string, `HARD SKILLS` string, "),
                       ([("u3", ["m", "n"], *date)], "job_url string, hard_skills array<string>, ")):
        writers.write_partitioned(spark.createDataFrame(rows, kind + tail), root, mode="append")
    dates = spark.createDataFrame([date], tail)
    rows, mode = raw_reads.read_dates(spark, root, dates)
    assert mode == "parsed"
    assert {r["job_url"]: r["hard_skills"] for r in rows.collect()} == {"u1": ["x", "y"], "u2": ["p", "q"], "u3": ["m", "n"]}
    with pytest.raises(ValueError, match="row"):
        raw_reads.read_dates(spark, root, dates, "sniff")


def test_ids_expanded_after_the_shuffle_equal_row_number(spark):
    rows = [(f"u{i % 50}", [f"s{k}" for k in range(i % 4)], "2024", "01", "03" if i % 3 else "04") for i in range(200)]
    df = spark.createDataFrame(rows, "job_url string, hard_skills array<string>, year string, month string, day string")
    df = df.dropDuplicates(["job_url", "day"])
    got = ids.sequence_ids(df, ["year", "month", "day"], ["job_url"], num_partitions=5, expand=skills.explode_skills)
    want = skills.explode_skills(df).withColumn("want", F.row_number().over(
        Window.partitionBy("year", "month", "day").orderBy("job_url", "skill_pos")))
    both = got.join(want, ["year", "month", "day", "job_url", "skill_pos"])
    assert both.count() == want.count() > 0 and both.where("id <> want").count() == 0
