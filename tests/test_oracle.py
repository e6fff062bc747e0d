"""Every registered query against its DuckDB oracle at sf0.001 (count + values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from hirewave.fixtures import BASE_TABLES

SF = "/root/testdata/sf0.001"
# registered queries that land tables (slow on this file system); run with -m slow
WRITERS = {"raw_landing", "scan_partition", "list_partitions", "list_partitions_scan", "latest_partition",
           "remaining_dates", "remaining_dates_none_left", "remaining_dates_no_dest", "raw_zone_inventory",
           "single_partition", "remaining_dates_late_files", "silver_republish", "silver_all_tables", "incremental_then_batch",
           "silver_roundtrip", "csv_roundtrip", "csv_append", "land_by_run_date", "validation_table", "incremental_silver"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", [k for k in KEYS if k not in WRITERS])
def test_query_matches_oracle(spark, con, key):
    _check(spark, con, key)


@pytest.mark.slow
@pytest.mark.parametrize("key", sorted(WRITERS))
def test_writer_query_matches_oracle(spark, con, key):
    _check(spark, con, key)


def _check(spark, con, key):
    df = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    drows = res.fetchall()
    assert len(srows) == len(drows)
    assert _bag(df.columns, srows) == _bag(res.columns, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.schema == E.entry(spark).schema


def test_date_columns_are_known(spark):
    """Every DATE column a raw builder returns is one the oracle wrapper casts."""
    from pyspark.sql.types import DateType

    from hirewave.plans import registry
    raw = registry.raw_queries()
    for key in KEYS:
        if key in WRITERS or key not in raw:
            continue
        schema = raw[key](spark, SF).schema
        dates = {f.name for f in schema.fields if isinstance(f.dataType, DateType)}
        assert dates <= set(registry.DATE_NAMES), (key, dates)
