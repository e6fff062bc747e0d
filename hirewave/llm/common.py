"""Shared steps of the operators: lineage cuts, a global order, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    The result no longer depends on the shuffle files of lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, order: list[Column], rank_col: str, name: str) -> DataFrame:
    """Number all rows 0.. in ``order`` (which must be total) without one big task.

    Rows are range partitioned and sorted; a row's number is its place in its
    partition plus the sizes of the partitions before it (one number per
    partition).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")  # one row per partition
            .withColumn(rank_col, F.col("_start") + within)
            .drop("_part", "_place", "_start"))


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node.

    Alternating large-star / small-star rounds over the edge list: every step
    is a min aggregation and a join, the list never grows, and rounds stop
    when it no longer changes (a logarithmic number of rounds).  Each round is
    written to the shared folder, so lineage stays short.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, state = materialize(pairs, name), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state or mark[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = mark
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        current = materialize(small, name)
