"""DuckDB texts that compute the same results as the Spark plans.

These are the independent check (``oracle_sql`` in ``__spark_entry__``):
plain SQL over the driver tables, written stage by stage as CTEs.
"""

from __future__ import annotations

from hirewave import fixtures
from hirewave.functions import exprs, rules

_TRIMMED = ", ".join(
    f"trim({c}) as {c}" for c in ["extract_date", "department", "domains", "title", "company",
                                  "location", "job_type", "job_url", "description"])
_DEDUP_KEYS = "company, department, domains, title, extract_date, location, job_type, description, org, role, domain, year, month, day"

STAGES: dict[str, str] = {
    "postings": fixtures.POSTINGS_SQL,
    "companies": fixtures.COMPANIES_SQL,
    "trimmed": f"select * replace ({_TRIMMED}) from postings",
    "deduped": ("select * exclude (_rn) from (select *, row_number() over (partition by "
                f"{_DEDUP_KEYS} order by job_url) as _rn from trimmed) where _rn = 1"),
    "located": ("select * replace (coalesce(array_to_string(string_split(location, ', '), '-'), '') as location), "
                "case when len(string_split(location, ', ')) = 2 then string_split(location, ', ')[2] else '' end as state, "
                "case when len(string_split(location, ', ')) = 2 then string_split(location, ', ')[1] "
                "else coalesce(array_to_string(string_split(location, ', '), ','), '') end as place from deduped"),
    "dated": ("select * replace (try_cast(extract_date as date) as extract_date) from located "
              "where try_cast(extract_date as date) is not null"),
    "titled": f"select * replace ({exprs.strip_title_duckdb('lower(title)')} as title) from dated",
    "kept_companies": f"select * from companies where not {exprs.dropped_industry_duckdb('company_industry')}",
}

_EDGES = r"(^\[')|('\]$)".replace("'", "''")
Q = "'"


def comma_sql(c: str) -> str:
    return f"string_split(regexp_replace({c}, '{_EDGES}', '', 'g'), {exprs.sql_str(Q + ', ' + Q)})"


def space_sql(c: str) -> str:
    return (f"string_split(replace(regexp_replace({c}, '{_EDGES}', '', 'g'), chr(10), ''), "
            f"{exprs.sql_str(Q + ' ' + Q)})")


def distinct_sql(lst: str) -> str:
    """Order-keeping distinct (first occurrence wins), like Spark array_distinct."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def parse_stage(src: str, mode: str = "auto") -> str:
    inner = f"select *, {comma_sql('hard_skills')} as _comma, {space_sql('hard_skills')} as _space from {src}"
    if mode == "comma":
        pick = distinct_sql("_comma")
    elif mode == "space":
        pick = "_space"
    else:
        pick = f"case when contains(hard_skills, {exprs.sql_str(Q + ' ' + Q)}) then _space else {distinct_sql('_comma')} end"
    return f"select * exclude (_comma, _space) replace ({pick} as hard_skills) from ({inner})"


# columns of the joined stage, as the silver projection sees them
_JOINED_PRESENT = {"extract_date", "department", "domains", "title_cleaned", "title", "company", "location",
                   "job_type", "job_url", "domain", "hard_skills", "org", "role", "state", "place",
                   "company_name", "company_industry", "year", "month", "day"}


def projection_sql() -> str:
    cols = []
    for name in rules.SILVER_COLUMNS:
        if name.lower() in _JOINED_PRESENT:
            cols.append(f"{name.lower()} as {name}")
        else:
            cols.append(f"cast(null as varchar) as {name}")
    return ", ".join(cols)


STAGES.update({
    "parsed": parse_stage("titled"),
    "joined": ("select t.*, k.company_name, k.company_industry from parsed t "
               "left join kept_companies k on t.company = k.company_name"),
    "enriched": (f"select {projection_sql()} from (select * replace (list_transform(hard_skills, lambda skill: "
                 f"{exprs.skill_taxonomy_sql('skill')}) as hard_skills), {exprs.title_taxonomy_sql('title')} as title_cleaned "
                 "from joined)"),
    "silver": (f"select *, {exprs.verticals_duckdb('company_industry')} as verticals from enriched "
               f"where not {exprs.manager_title_duckdb('title')}"),
})

# stage dependencies, in build order
_ORDER = ["postings", "companies", "trimmed", "deduped", "located", "dated", "titled", "kept_companies",
          "parsed", "joined", "enriched", "silver"]


def with_stages(body: str, *needed: str, extra: dict[str, str] | None = None, postings: str | None = None) -> str:
    """Emit the CTE chain up to the needed stages, then ``body``; ``postings`` replaces the first stage."""
    deps = {
        "trimmed": ["postings"], "deduped": ["trimmed"], "located": ["deduped"], "dated": ["located"],
        "titled": ["dated"], "kept_companies": ["companies"], "parsed": ["titled"],
        "joined": ["parsed", "kept_companies"], "enriched": ["joined"], "silver": ["enriched"],
    }
    want: set[str] = set()

    def add(n: str) -> None:
        if n in want:
            return
        want.add(n)
        for d in deps.get(n, []):
            add(d)

    for n in needed:
        add(n)
    ctes = {n: STAGES[n] for n in _ORDER if n in want}
    if postings:
        ctes["postings"] = postings
    ctes.update(extra or {})
    return fixtures.with_ctes(body, **ctes)
