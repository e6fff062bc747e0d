"""Rule lists -> one Spark expression each (and the same rules as SQL text).

A 53-branch CASE is one Catalyst expression: it is built once from the
rule data, never as a chain of ``withColumn`` calls, so the whole chain
stays inside one whole-stage-codegen projection.  LikeSimplification
turns ``%x%`` into ``Contains`` and ``x%`` into ``StartsWith``.

The ``*_sql`` twins render the same rules as ANSI SQL text; they are used
for SQL-over-view plans and for the DuckDB oracle texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirewave.functions import rules


def sql_str(value: str) -> str:
    """Single-quoted SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ---------------------------------------------------------------- titles
def title_taxonomy_col(column: str = "title") -> Column:
    """The title chain from its SQL text: one JVM parse instead of hundreds of
    Python -> JVM calls to build the same expression."""
    return F.expr(title_taxonomy_sql(_q(column)))


def title_taxonomy(title: Column) -> Column:
    expr = None
    for label, patterns in rules.TITLE_RULES:
        cond = None
        for p in patterns:
            c = title.like(p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(title)


def title_taxonomy_sql(title: str = "title") -> str:
    parts = ["CASE"]
    for label, patterns in rules.TITLE_RULES:
        cond = " OR ".join(f"{title} LIKE {sql_str(p)}" for p in patterns)
        parts.append(f" WHEN {cond} THEN {sql_str(label)}")
    parts.append(f" ELSE {title} END")
    return "".join(parts)


# ---------------------------------------------------------------- skills
def skill_taxonomy_col(column: str = "hard_skills") -> Column:
    """Skill chain on a scalar column, built from its SQL text."""
    return F.expr(skill_taxonomy_sql(_q(column)))


def skill_taxonomy_each(column: str = "hard_skills") -> Column:
    """Skill chain applied to every element of an array column (``transform``), each lower-cased once, not once a pattern."""
    return F.expr(f"transform(transform({_q(column)}, x -> named_struct('skill', x, 'low', lower(x))), "
                  f"p -> {skill_taxonomy_sql('p.skill', 'p.low')})")


def skill_taxonomy(skill: Column) -> Column:
    low = F.lower(skill)
    expr = None
    for label, patterns in rules.SKILL_RULES:
        cond = None
        for p, case_sensitive in patterns:
            c = (skill if case_sensitive else low).like(p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(skill)


def skill_taxonomy_sql(skill: str = "skill", low: str | None = None) -> str:
    """The chain on ``skill``; ``low`` names its lower case where that is at hand."""
    low, parts = low or f"lower({skill})", ["CASE"]
    for label, patterns in rules.SKILL_RULES:
        cond = " OR ".join(
            f"{skill if cs else low} LIKE {sql_str(p)}" for p, cs in patterns
        )
        parts.append(f" WHEN {cond} THEN {sql_str(label)}")
    parts.append(f" ELSE {skill} END")
    return "".join(parts)


# ---------------------------------------------------------------- verticals
def verticals(industry: Column) -> Column:
    expr = None
    for label, alternation in rules.VERTICAL_RULES:
        cond = industry.rlike(f"(?i)({alternation})")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rules.VERTICAL_DEFAULT))


def verticals_duckdb(industry: str = "company_industry") -> str:
    parts = ["CASE"]
    for label, alternation in rules.VERTICAL_RULES:
        parts.append(f" WHEN regexp_matches({industry}, {sql_str('(' + alternation + ')')}, 'i') THEN {sql_str(label)}")
    parts.append(f" ELSE {sql_str(rules.VERTICAL_DEFAULT)} END")
    return "".join(parts)


# ---------------------------------------------------------------- word filters
def manager_title(title: Column) -> Column:
    """True when the title holds a managerial / off-topic word (any case)."""
    return title.rlike("(?i)(" + "|".join(rules.MANAGER_WORDS) + ")")


def manager_title_duckdb(title: str = "title") -> str:
    return f"regexp_matches({title}, {sql_str('(' + '|'.join(rules.MANAGER_WORDS) + ')')}, 'i')"


def dropped_industry(industry: Column, ignore_case: bool = False) -> Column:
    flags = "(?i)" if ignore_case else ""
    return industry.rlike(flags + "(" + "|".join(rules.INDUSTRY_WORDS) + ")")


def dropped_industry_duckdb(industry: str = "company_industry", ignore_case: bool = False) -> str:
    opt = ", 'i'" if ignore_case else ""
    return f"regexp_matches({industry}, {sql_str('(' + '|'.join(rules.INDUSTRY_WORDS) + ')')}{opt})"


# ---------------------------------------------------------------- title strip
def strip_title(title: Column) -> Column:
    out = title
    for pattern in rules.TITLE_STRIP_PATTERNS:
        out = F.regexp_replace(out, pattern, "")
    return out


def strip_title_duckdb(title: str = "title") -> str:
    out = title
    for pattern in rules.TITLE_STRIP_PATTERNS:
        out = f"regexp_replace({out}, {sql_str(pattern)}, '', 'g')"
    return out
