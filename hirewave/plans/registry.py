"""Registered queries: name -> (Spark plan builder, DuckDB oracle text or None).

Every builder takes ``(spark, sf_dir)``, reads the driver tables of that
scale factor (or data Spark derives from them) and returns a lazy
DataFrame.  Array columns are returned joined with '|' and DATE columns as
ISO text ('yyyy-MM-dd'), so both engines print and hash them the same way
whatever client conversion is used (a DATE turns into a date object in one
engine's pandas output and into a midnight timestamp in the other's).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from hirewave import fixtures
from hirewave.operators import clean, quality
from hirewave.plans import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_rows(fixtures.postings(spark, sf_dir))


# ------------------------------------------------------------------ VAL-01
@register("department_counts", O.with_stages(
    "select department, extract_date, year, month, day, count(*) as record_count "
    "from titled group by department, extract_date, year, month, day", "titled"))
def q_department_counts(spark, sf_dir):
    return quality.department_counts(_titled(spark, sf_dir))


# output columns that may hold a DATE (checked by tests/test_oracle.py)
DATE_NAMES = ("extract_date", "Date", "posted_on")


def comparable(df: DataFrame) -> DataFrame:
    """DATE columns as ISO text (arrays are joined by the builders)."""
    dates = {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, DateType)}
    return df.withColumns(dates) if dates else df


def _wrap(fn: Builder) -> Builder:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def oracle_comparable(sql: str) -> str:
    """Same for the DuckDB text: the date-named columns cast to varchar (a
    padding column keeps the cast set non-empty when none is present)."""
    names = ", ".join(f"'{n}'" for n in DATE_NAMES + ("_pad_",))
    return ("select * exclude (_pad_) from (select columns(lambda c: c not in (" + names + ")), "
            "cast(columns(lambda c: c in (" + names + ")) as varchar) from (select *, 0 as _pad_ from (\n"
            + sql + "\n)))")


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: _wrap(v[0]) for k, v in REGISTRY.items()}


def raw_queries() -> dict[str, Builder]:
    """The builders without the comparison projection (library types)."""
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: oracle_comparable(v[1]) for k, v in REGISTRY.items() if v[1] is not None}


def _load_all() -> None:
    # modules that register more queries
    from hirewave.plans import queries_clean, queries_harvest, queries_io  # noqa: F401
