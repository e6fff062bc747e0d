"""Raw postings -> the two silver tables and their row counts.

One job over *all* dates handed in (not a driver loop per date):

    postings (scan of the given dates) -> trim -> dedup -> aliases -> location -> date
    -> title -> skills parse -> LEFT JOIN companies (latest, filtered)
    -> title / skill taxonomies -> 43-column projection -> verticals
    -> manager filter                       = silver, unexploded
    -> explode skills -> contiguous ids     = silver, exploded

The date dimension (year, month, day) is carried as an extra key through
dedup, ids and counts, so running dates one by one or all at once gives
the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewave.functions import rules
from hirewave.operators import clean, enrich, ids, quality, skills

P = rules.PARTITION_COLUMNS


def project_silver(df: DataFrame, *more: Column) -> DataFrame:
    """The fixed 43-column order, then ``more``; absent optional columns become typed NULLs."""
    lower = {c.lower(): c for c in df.columns}
    cols = []
    for name in rules.SILVER_COLUMNS:
        src = lower.get(name.lower())
        cols.append(F.col(src).alias(name) if src is not None else clean.typed_null(name))
    return df.select(*cols, *more)


def _labelled(postings: DataFrame, companies: DataFrame, skills_mode: str) -> DataFrame:
    """Cleaned rows joined to companies (one a name), both taxonomies applied."""
    rows = clean.clean_rows(postings).transform(lambda d: skills.parse_skills(d, mode=skills_mode))
    return clean.add_title_cleaned(skills.map_skills(enrich.join_companies(rows, companies)))


def enriched(postings: DataFrame, companies_kept: DataFrame, skills_mode: str = "row") -> DataFrame:
    """Cleaned rows joined to companies, both taxonomies applied, projected."""
    return project_silver(_labelled(postings, enrich.one_per_name(companies_kept), skills_mode))


def from_prepared(postings: DataFrame, companies_kept: DataFrame, skills_mode: str = "row") -> DataFrame:
    """Silver, unexploded, with the companies that are left after the industry filter.

    The vertical is worked out once a company, not once a posting; postings without a company have the default.
    """
    named = clean.add_verticals(enrich.one_per_name(companies_kept), name="_vertical")
    rows = _labelled(postings, named, skills_mode)
    vertical = F.coalesce(F.col("_vertical"), F.lit(rules.VERTICAL_DEFAULT)).alias("verticals")
    return clean.drop_managers(project_silver(rows, vertical))


def silver_unexploded(postings: DataFrame, companies: DataFrame, skills_mode: str = "row") -> DataFrame:
    _, kept = enrich.prepare_companies(companies)
    return from_prepared(postings, kept, skills_mode)


def silver_exploded(unexploded: DataFrame) -> DataFrame:
    """One skill per row, ``hard_skills_array`` kept, contiguous id per date."""
    # the last key tells rows of one url apart, so the order is total
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in unexploded.columns])
    return ids.sequence_ids(unexploded.withColumn("_tie", tie), P, ["extract_date", "job_url", "company_name", "_tie"],
                            expand=lambda d: skills.explode_skills(d.drop("_tie")))


def exploded_of_table(table: DataFrame) -> DataFrame:
    """``silver_exploded`` of unexploded rows that lie in files: only narrow keys are put in order."""
    return ids.list_ids(table, P, ["extract_date", "job_url", "company_name"], "hard_skills")


@dataclass
class SilverRun:
    """The outputs of one run.  ``exploded`` is built on first use: its ids
    need a checkpoint job, which callers that only want counts never pay."""

    unexploded: DataFrame
    counts: DataFrame
    _exploded: DataFrame | None = None

    @property
    def exploded(self) -> DataFrame:
        if self._exploded is None:
            self._exploded = silver_exploded(self.unexploded)
        return self._exploded


def build(postings: DataFrame, companies: DataFrame, skills_mode: str = "row") -> SilverRun:
    base, kept = enrich.prepare_companies(companies)
    unexploded = from_prepared(postings, kept, skills_mode)
    counts = quality.funnel_counts(postings, base, kept, unexploded)
    return SilverRun(unexploded, counts)
