"""Partitioned sources and sinks: padding, date sync, idempotent writes, CSV."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hirewave.sinks import writers
from hirewave.sources import catalog, partitions

P = ["year", "month", "day"]


def _dates(spark, triples):
    return spark.createDataFrame(triples, "year string, month string, day string")


def test_latest_partition_needs_padding(spark):
    padded = _dates(spark, [("2024", "02", "09"), ("2024", "02", "10")])
    assert tuple(partitions.latest_partition(padded).first()) == ("2024", "02", "10")
    unpadded = _dates(spark, [("2024", "02", "9"), ("2024", "02", "10")])
    assert tuple(partitions.latest_partition(unpadded).first()) == ("2024", "02", "9")  # why padding matters


def test_remaining_dates_three_cases(spark):
    src = _dates(spark, [("2024", "01", "01"), ("2024", "01", "02"), ("2024", "01", "03")])
    dest = _dates(spark, [("2024", "01", "01")])
    assert sorted(map(tuple, partitions.remaining_dates(src, dest).collect())) == [
        ("2024", "01", "02"), ("2024", "01", "03")]
    assert [tuple(r) for r in partitions.remaining_dates(src, src).collect()] == [("2024", "01", "03")]
    assert partitions.remaining_dates(src, None).count() == 3
    rem = partitions.remaining_dates(src, dest)
    assert rem.join(dest, P, "inner").count() == 0          # remaining ∩ destination = ∅


def _rows(spark, day, n, tag):
    return spark.createDataFrame([(f"{tag}{i}", "2024", "01", day) for i in range(n)],
                                 "k string, year string, month string, day string")


def test_write_read_partition_strings_and_pruning(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    writers.write_partitioned(_rows(spark, "03", 3, "a").unionByName(_rows(spark, "04", 2, "b")), path)
    df = partitions.read_partitioned(spark, path)
    assert dict(df.dtypes)["month"] == "string"
    one = partitions.scan_partition(spark, path, "2024", "01", "04")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionfilters" in plan.lower()


def test_dynamic_overwrite_touches_only_present_dates(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    writers.write_partitioned(_rows(spark, "03", 3, "a").unionByName(_rows(spark, "04", 2, "b")), path)
    writers.write_partitioned(_rows(spark, "04", 5, "c"), path)       # redo one date
    writers.write_partitioned(_rows(spark, "04", 5, "c"), path)       # twice: same table
    got = partitions.read_partitioned(spark, path).groupBy("day").count().collect()
    assert {r["day"]: r["count"] for r in got} == {"03": 3, "04": 5}


def test_catalog_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    writers.write_partitioned(_rows(spark, "03", 1, "a").unionByName(_rows(spark, "10", 1, "b")), path)
    t = catalog.register_table(spark, "cat_test", path, database="test_zone")
    assert [tuple(r) for r in catalog.show_partitions(spark, t).collect()] == [
        ("2024", "01", "03"), ("2024", "01", "10")]
    assert "cat_test" in catalog.list_tables(spark, "test_zone")
    assert catalog.table_partitions_or_none(spark, "no_such_db.t") is None


def test_csv_roundtrip_keeps_blank_null_and_newline(spark, tmp_dir):
    df = spark.createDataFrame([("a", "", None, "x\ny", " pad ")], "k string, e string, n string, m string, p string")
    path = os.path.join(tmp_dir, "c")
    writers.write_csv(df, path)
    writers.append_csv(df, path)                      # one header per part file
    back = writers.read_csv(spark, path).collect()
    assert len(back) == 2
    assert all(tuple(r) == ("a", "", None, "x\ny", " pad ") for r in back)


def test_stringify_all(spark):
    df = spark.createDataFrame([(1, None, ["a", "b"])], "i bigint, s string, a array<string>")
    r = writers.stringify_all(df).first()
    assert tuple(r) == ("1", None, "['a', 'b']")
    r2 = writers.stringify_all(df, null_token="nan").first()
    assert r2["s"] == "nan"


def test_partition_columns_zero_padded(spark):
    df = spark.createDataFrame([("2024-01-03",)], "d string").select(F.to_date("d").alias("d"))
    r = df.select(*[v.alias(k) for k, v in writers.partition_columns(F.col("d")).items()]).first()
    assert tuple(r) == ("2024", "01", "03")


def test_fixed_schema_even_without_rows(spark):
    schema = StructType([StructField(c, StringType()) for c in
                         ["extract_date", "department", "main_title", "job_title", "url"]])
    empty = spark.createDataFrame([], schema)
    assert empty.columns == ["extract_date", "department", "main_title", "job_title", "url"]
    assert empty.count() == 0
