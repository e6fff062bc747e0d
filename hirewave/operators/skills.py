"""Skill lists: parse the two printed encodings, dedupe, map, explode.

``hard_skills`` arrives as a true array, or as a printed Python list in one
of two forms:

* comma form ``['a', 'b']`` -> strip ``['`` / ``']``, split on ``', '``, dedupe;
* space form ``['a' 'b'\\n 'c']`` (a printed array) -> strip, drop newlines,
  split on ``' '``; no dedupe.

The default picks the parser **per row**, so a batch that mixes both
forms parses correctly with no extra job.  ``mode='sniff'`` reproduces the
original table-level choice, per date: the first row by ``hard_skills``
(NULL first) decides for its whole date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from hirewave.functions import exprs, rules

P = rules.PARTITION_COLUMNS
_EDGES = rules.SKILL_LIST_EDGES
SPACE_MARK = rules.SKILL_SPACE_SEP


def parse_comma(c: Column) -> Column:
    return F.array_distinct(F.split(F.regexp_replace(c, _EDGES, ""), rules.SKILL_COMMA_SEP))


def parse_space(c: Column) -> Column:
    return F.split(F.regexp_replace(F.regexp_replace(c, _EDGES, ""), rules.SKILL_SPACE_DROP, ""), SPACE_MARK)


def parse_auto(c: Column) -> Column:
    return F.when(c.contains(SPACE_MARK), parse_space(c)).otherwise(parse_comma(c))


# CLN-13 (sniff): one format per date
def sniff_format(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """Per (year, month, day): 'space' or 'comma', as the first row by skills decides.

    A partial aggregate (min + null flag) — no sort of the date, no group
    collected into one task.  A NULL sorts first and selects the comma form.
    """
    c = F.col(column)
    return (df.groupBy(*P)
              .agg(F.min(c).alias("_first"), F.max(c.isNull().cast("int")).alias("_has_null"))
              .select(*P, F.when(F.col("_has_null") == 1, F.lit("comma"))
                           .when(F.col("_first").contains(SPACE_MARK), F.lit("space"))
                           .otherwise(F.lit("comma")).alias("skills_format")))


# CLN-10
def array_siblings_to_text(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """Entity columns that arrive as arrays are cast to text ('[a, b]')."""
    lower = {c.lower(): c for c in df.columns}
    casts = {lower[n.lower()]: F.col(lower[n.lower()]).cast("string")
             for n in rules.ARRAY_SIBLING_COLUMNS
             if n.lower() in lower and lower[n.lower()] != column
             and isinstance(df.schema[lower[n.lower()]].dataType, ArrayType)}
    return df.withColumns(casts) if casts else df


def array_skills(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """True-array skills: cast the sibling entity columns to string, dedupe skills in place."""
    lower = {c.lower(): c for c in df.columns}
    casts = {lower[n.lower()]: F.col(lower[n.lower()]).cast("string")
             for n in rules.ARRAY_SIBLING_COLUMNS if n.lower() in lower and lower[n.lower()] != column}
    return df.withColumns({**casts, column: F.array_distinct(F.col(column))})


def _parse_one(df: DataFrame, name: str, mode: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, ArrayType):
        return F.array_distinct(F.col(name))
    if mode == "space":
        return parse_space(F.col(name))
    if mode == "comma":
        return parse_comma(F.col(name))
    return parse_auto(F.col(name))


def coalesce_variants(df: DataFrame, mode: str = "row") -> DataFrame:
    """Several producer spellings in one frame: each is parsed by its own type
    (string forms per row, arrays deduped) and the results are coalesced into
    ``hard_skills``; soft skills likewise into ``soft_skills`` (as text)."""
    from hirewave.operators.clean import skill_variants
    hard = skill_variants(df)
    soft = skill_variants(df, soft=True)
    out = df
    if len(hard) > 1:
        out = out.withColumn("_hard", F.coalesce(*[_parse_one(df, n, mode) for n in hard])).drop(*hard) \
                 .withColumnRenamed("_hard", "hard_skills")
    if len(soft) > 1:
        out = out.withColumn("_soft", F.coalesce(*[F.col(n).cast("string") for n in soft])).drop(*soft) \
                 .withColumnRenamed("_soft", "soft_skills")
    return out


def parse_skills(df: DataFrame, column: str = "hard_skills", mode: str = "row") -> DataFrame:
    """Schema-driven: arrays are deduped, strings parsed; other types pass through.

    ``mode='parsed'``: the skills were already parsed upstream (per file
    schema, see ``hirewave.sources.raw``); nothing is done.
    """
    from hirewave.operators.clean import skill_variants
    if mode == "parsed":
        return df
    if column == "hard_skills" and len(skill_variants(df)) > 1:
        if mode == "sniff":
            raise ValueError("mode 'sniff' needs one skills column; use mode 'row' for producers that spell it differently")
        return array_siblings_to_text(coalesce_variants(df, mode))
    dtype = df.schema[column].dataType
    if isinstance(dtype, ArrayType):
        return array_skills(df, column)
    if not isinstance(dtype, StringType):
        return df
    c = F.col(column)
    if mode == "row":
        return df.withColumn(column, parse_auto(c))
    if mode == "sniff":
        # one row per date: bounded by the calendar, safe to broadcast
        fmt = F.broadcast(sniff_format(df, column))
        return (df.join(fmt, P, "left")
                  .withColumn(column, F.when(F.col("skills_format") == "space", parse_space(c))
                                       .otherwise(parse_comma(c)))
                  .drop("skills_format"))
    if mode == "comma":
        return df.withColumn(column, parse_comma(c))
    if mode == "space":
        return df.withColumn(column, parse_space(c))
    raise ValueError(f"unknown mode {mode}")


# CLN-15
def map_skills(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """Skill taxonomy on every element, in place (narrow, no shuffle)."""
    return df.withColumn(column, exprs.skill_taxonomy_each(column))


def map_skill(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """Skill taxonomy on a scalar (already exploded) skill column."""
    return df.withColumn(column, exprs.skill_taxonomy_col(column))


# GEN-01
def explode_skills(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """Keep the list as ``hard_skills_array``; one row per skill with its position.

    NULL and empty lists produce no row.
    """
    cols = [c for c in df.columns if c != column]
    return df.select(*cols, F.col(column).alias(f"{column}_array"),
                     F.posexplode(F.col(column)).alias("skill_pos", column))
