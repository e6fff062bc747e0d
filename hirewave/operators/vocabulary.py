"""Skill taxonomy by vocabulary: the rules run once for each different skill, the labels are joined back.

The rule chain (59 rules of LIKE patterns) costs more than a lookup when
skills repeat often and rows are narrow; on wide rows the join moves more than
the rules cost, so the silver job maps in place (``skills.map_skills``).
Nothing is broadcast by hint: the vocabulary has no proven size.  A few
frequent skills may hold most rows, so theirs are dealt over ``SPLIT`` keys,
with as many copies of their vocabulary entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewave.functions import exprs

#: skills that are split, at most, and keys each is split over
HOT = 64
SPLIT = 32
#: entries the frequency sketch tracks
TRACKED = 4096


def hot_skills(df: DataFrame, column: str) -> Column:
    """The about ``HOT`` most frequent skills as an array, worked out once by a sketch of fixed size.

    A skill that is missing from it is joined unsplit, with the same result.
    """
    items = F.transform(F.call_function("approx_top_k", F.col(f"`{column}`"), F.lit(HOT), F.lit(TRACKED)), lambda x: x["item"])
    return F.coalesce(df.agg(items.alias("hot")).scalar(), F.array().cast("array<string>"))


def skill_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """(skill, label) of every different skill; equal skills are put together in every task before the shuffle."""
    words = df.select(F.col(f"`{column}`").alias("_skill")).where("_skill is not null").groupBy("_skill").agg(F.count(F.lit(1)).alias("_n"))
    return words.select("_skill", exprs.skill_taxonomy_col("_skill").alias("_label"))


def map_by_vocabulary(df: DataFrame, column: str = "hard_skills") -> DataFrame:
    """``skills.map_skill`` by vocabulary: ``column`` holds a skill a row; null stays null."""
    hot, spread = hot_skills(df, column), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SPLIT))
    is_hot = lambda c: F.coalesce(F.array_contains(hot, c), F.lit(False))
    keys = F.when(is_hot(F.col("_skill")), F.sequence(F.lit(0).cast("long"), F.lit(SPLIT - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    words = skill_vocabulary(df, column).withColumn("_key", F.explode(keys))
    rows = df.withColumn("_at", F.when(is_hot(F.col(f"`{column}`")), spread).otherwise(F.lit(0)).cast("long"))
    joined = rows.join(words, (rows[f"`{column}`"] == words["_skill"]) & (rows["_at"] == words["_key"]), "left")
    return joined.select(*[F.col("_label").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


def map_lists_by_vocabulary(df: DataFrame, keys: list[str], column: str = "hard_skills") -> DataFrame:
    """``keys`` and the mapped list of every row; ``keys`` must tell rows apart.

    Lists keep their order; null and empty lists stay as they are.
    """
    size = F.when(F.col(column).isNotNull(), F.size(column)).alias("_size")
    parts = df.select(*keys, size, F.posexplode_outer(column).alias("_pos", column))
    mapped = map_by_vocabulary(parts, column)
    entry = F.when(F.col("_pos").isNotNull(), F.struct("_pos", column))
    lists = mapped.groupBy(*keys, "_size").agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    return lists.select(*keys, F.when(F.col("_size").isNotNull(), F.transform("_l", lambda x: x[column])).alias(column))
