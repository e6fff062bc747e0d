"""Row cleaning: every step is a pure ``DataFrame -> DataFrame`` function.

All steps are narrow (no shuffle) except :func:`dedup_postings`, which is
one sort aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewave.functions import exprs, rules


def _present(df: DataFrame, names: list[str]) -> list[str]:
    """Names from ``names`` that exist in ``df`` (case-insensitive), as spelled in df."""
    lower = {c.lower(): c for c in df.columns}
    return [lower[n.lower()] for n in names if n.lower() in lower]


# CLN-01
def trim_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Trim blanks (only ' ', like SQL TRIM) from the named string columns."""
    cols = _present(df, columns or rules.TRIM_COLUMNS)
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


# CLN-02
def skill_variants(df: DataFrame, soft: bool = False) -> list[str]:
    """Skill columns present in ``df``, canonical name first."""
    idx = 1 if soft else 0
    names = ["soft_skills" if soft else "hard_skills"] + [a[idx] for a in rules.SKILL_COLUMN_ALIASES]
    return [n for n in names if n in df.columns]


def resolve_aliases(df: DataFrame) -> DataFrame:
    """Rename the producer spelling of the skill columns to hard_skills / soft_skills.

    When one scan holds files of several producers (a mergeSchema read over
    dates written by both), several spellings are present; they are left
    for :func:`hirewave.operators.skills.parse_skills`, which parses each by
    its own type and coalesces them.
    """
    renames = {}
    for soft in (False, True):
        present = skill_variants(df, soft)
        if len(present) == 1 and present[0] not in ("hard_skills", "soft_skills"):
            renames[present[0]] = "soft_skills" if soft else "hard_skills"
    return df.withColumnsRenamed(renames) if renames else df


# CLN-05
def split_location(df: DataFrame) -> DataFrame:
    """location 'place, state' -> place, state; other shapes keep the parts joined.

    location becomes the parts joined by '-'; a NULL location gives '' in all three.
    """
    parts = F.split(F.col("location"), rules.LOCATION_SEP)
    two = F.col("location").isNotNull() & (F.size(parts) == 2)
    return df.withColumns({
        "state": F.when(two, F.get(parts, 1)).otherwise(F.lit("")),
        "place": F.when(two, F.get(parts, 0)).otherwise(F.concat_ws(rules.LOCATION_PLACE_JOIN, parts)),
        "location": F.concat_ws(rules.LOCATION_JOIN, parts),
    })


# CLN-06 / CLN-07
def valid_dates(df: DataFrame, column: str = "extract_date") -> DataFrame:
    """Parse the date; rows that do not parse ('nan', repeated header, NULL) go."""
    return df.withColumn(column, F.try_to_date(F.col(column))).where(F.col(column).isNotNull())


# CLN-08 / CLN-09
def clean_title(df: DataFrame) -> DataFrame:
    """Lower-case the title, then strip money, remote/hybrid marks and empty '()'."""
    return df.withColumn("title", exprs.strip_title(F.lower(F.col("title"))))


# CLN-14
def add_title_cleaned(df: DataFrame) -> DataFrame:
    return df.withColumn("title_cleaned", exprs.title_taxonomy_col("title"))


# CLN-17
def add_verticals(df: DataFrame, column: str = "company_industry", name: str = "verticals") -> DataFrame:
    return df.withColumn(name, exprs.verticals(F.col(column)))


# CLN-18
def drop_managers(df: DataFrame) -> DataFrame:
    """Drop managerial / off-topic titles; a NULL title is dropped as well."""
    return df.where(~exprs.manager_title(F.col("title")))


# CLN-19
def drop_industries(companies: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Drop companies whose industry holds a listed word (case-sensitive by default).

    A NULL industry is dropped too (NOT NULL -> NULL -> filtered).
    """
    return companies.where(~exprs.dropped_industry(F.col("company_industry"), ignore_case))


# AGG-01
def dedup_postings(df: DataFrame, keys: list[str] | None = None,
                   per_partition: bool = True, order_by: str = "job_url") -> DataFrame:
    """Drop repeated postings on the 11 posting keys (+ year/month/day).

    The survivor is deterministic: the row with the smallest ``job_url``,
    ties broken by the remaining columns.  It is one hash-partitioned
    aggregate of ``min(struct(...))``: map-side partial aggregation collapses
    repeated copies before the shuffle, so a key holding many copies costs one
    row per map task, never one huge group.
    """
    wanted = keys or rules.DEDUP_KEYS
    key_cols = _present(df, wanted)
    if len(key_cols) < len(wanted):
        raise ValueError(f"missing key columns: {sorted({k.lower() for k in wanted} - {c.lower() for c in df.columns})}")
    if per_partition:
        key_cols += [c for c in _present(df, rules.PARTITION_COLUMNS) if c not in key_cols]
    lower_keys = {k.lower() for k in key_cols}
    first = _present(df, [order_by]) if order_by.lower() not in lower_keys else []
    rest = [c for c in df.columns if c.lower() not in lower_keys and c not in first]
    survivor = F.min(F.struct(*[F.col(c) for c in first + rest])).alias("_survivor")
    # A 64-bit hash of the keys leads the grouping: the aggregate's sort then
    # compares one long first (prefix sort) instead of 14 strings.  The keys
    # themselves stay in the grouping, so a hash collision never merges rows.
    out = df.groupBy(F.xxhash64(*[F.col(c) for c in key_cols]).alias("_key_hash"), *key_cols).agg(survivor)
    return out.select(*[F.col(c) for c in key_cols],
                      *[F.col("_survivor").getField(c).alias(c) for c in first + rest]).select(*df.columns)


def clean_rows(df: DataFrame) -> DataFrame:
    """trim -> dedup -> aliases -> location -> date -> title (the row stage)."""
    return (df.transform(trim_columns)
              .transform(dedup_postings)
              .transform(resolve_aliases)
              .transform(split_location)
              .transform(valid_dates)
              .transform(clean_title))


def typed_null(name: str, dtype: str = "string") -> Column:
    return F.lit(None).cast(dtype).alias(name)
