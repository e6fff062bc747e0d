"""License scans by diagonal voting; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.llm.common import table
from hirewave.llm.urls import ascii_lower

GRAM = 2
#: fixed phrases (words stand consecutively) and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: further notices, found also with small changes
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "creative commons attribution share alike license": "cc-by-sa",
    "this work is dedicated to the public domain": "public-domain",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
}
MIN_COVER = 0.75
NEIGHBOUR = 2


def words(text: Column) -> Column:
    """Words of ASCII letters (A-Z lower-cased), digits and everything beyond ASCII; null and empty have none."""
    plain = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def template_grams(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(w1, w2, gram, template, label, is_base, at, grams): one row for each word pair of each template."""
    rows = []
    for t, (phrase, label, is_base) in enumerate(
            [(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in notices.items()]):
        w = phrase.split(" ")
        if len(w) < GRAM:
            raise ValueError("a template needs two words at least")
        rows += [(w[i], w[i + 1], t, label, is_base, i, len(w) - 1) for i in range(len(w) - 1)]
    return spark.createDataFrame(rows, "w1 string, w2 string, template int, label string, is_base boolean, at int, grams int"
                                 ).withColumn("gram", F.xxhash64("w1", "w2"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None,
         notices: dict[str, str] | None = None, min_cover: float = MIN_COVER, neighbour: int = NEIGHBOUR) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``.

    The hashes of all word pairs of all texts are joined to the templates'
    pairs (a fixed list, broadcast) and verified by their words.  Every hit
    votes for the diagonal text position - template position.  A base phrase
    stands where a diagonal has all its pairs.  For the longer notices
    neighbouring diagonals (up to ``neighbour`` words of shift) are merged, and
    a merged span counts when it covers ``min_cover`` of the template's pairs
    in order and is not longer than half as much again.  ``score`` is the best
    cover found (0 without any).  Without hits the labels are empty texts and
    the places null.  Null and empty texts have no words.  Rows that repeat id
    and text get the same result each.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, BASE if base is None else base, NOTICES if notices is None else notices)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tag"), words(F.col(text_col)).alias("w"))
    pairs = F.arrays_zip(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))).alias("w1"),
                         F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))).alias("w2"))
    spots = rows.select("id", "tag", F.posexplode(pairs).alias("pos", "p")).select(
        "id", "tag", "pos", F.col("p.w1").alias("a"), F.col("p.w2").alias("b"))
    spots = spots.withColumn("hash", F.xxhash64("a", "b"))
    hits = spots.join(F.broadcast(grams), (F.col("hash") == F.col("gram")) & (F.col("a") == F.col("w1")) & (F.col("b") == F.col("w2")))
    votes = hits.groupBy("id", "tag", "template", "label", "is_base", "grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"))
    each = Window.partitionBy("id", "tag", "template").orderBy("diagonal")
    votes = votes.withColumn("_new", F.when(
        F.col("is_base") | F.lag("diagonal").over(each).isNull() | (F.col("diagonal") - F.lag("diagonal").over(each) > neighbour), 1).otherwise(0))
    votes = votes.withColumn("_span", F.sum("_new").over(each.rowsBetween(Window.unboundedPreceding, 0)))
    spans = votes.groupBy("id", "tag", "template", "label", "is_base", "grams", "_span").agg(
        F.min("diagonal").alias("start"), F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n"),
        F.min(F.col("diagonal") + F.array_min("ats")).alias("lo"), F.max(F.col("diagonal") + F.array_max("ats")).alias("hi"))
    tight = (F.col("hi") - F.col("lo") + 1) <= F.col("grams") * 1.5
    spans = spans.withColumn("cover", F.when(tight, F.col("n") / F.col("grams")).otherwise(0.0))
    place, found = F.col("is_base") & (F.col("n") == F.col("grams")), F.when(F.col("is_base"), F.col("n") == F.col("grams")).otherwise(
        F.col("cover") >= min_cover)
    names = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    per_doc = spans.groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.sum(F.when(place, 1).otherwise(0)).alias("n_base"), F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"), names(place).alias("base_labels"),
        names(found).alias("labels"), F.max("cover").alias("score"))
    counts = rows.select("id", "tag", F.size("w").cast("long").alias("n_words"))
    joined = counts.join(per_doc, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    return joined.select("id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                         F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                         F.coalesce("score", F.lit(0.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
