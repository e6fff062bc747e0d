"""Contiguous row ids per group without sending a group to one task.

``row_number()`` over ``partitionBy(date)`` puts a whole date into one
task; a date may hold a third of all rows.  Instead:

1. range-partition the rows on (group, order) and sort inside each
   partition — the sampled range bounds split a hot date over many tasks —
   and cut lineage with a reliable ``checkpoint()``, so every later read
   sees the same rows in the same partitions;
2. expand them where asked (an explode is narrow and keeps the order, so
   only the unexploded rows are shuffled and checkpointed) and tag each row
   with its Spark partition id and ``monotonically_increasing_id()``
   (partition id << 33 + running index, so consecutive inside a partition);
3. count rows per (partition, group) — at most partitions + groups rows —
   and turn the counts into running offsets with a small window;
4. broadcast the offsets back: id = offset + index inside the partition + 1.

The result equals ``row_number() over (partition by group order by order)``
(tested), with one range shuffle and one small aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirewave.session import scratch_path, shared_dir


def sequence_ids(df: DataFrame, group_cols: list[str], order_cols: list[str],
                 id_col: str = "id", num_partitions: int | None = None,
                 expand: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` (after the narrow ``expand``) with ids 1.. in each group; rows one row expands to stay together."""
    spark = df.sparkSession
    shared_dir(spark)  # checkpoint target: the cluster's shared folder
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in group_cols + order_cols]
    # The range bounds are sampled by a job of their own; keeping the input
    # for the checkpoint job saves computing the upstream plan twice.
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        placed = src.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    finally:
        src.unpersist()
    rows = expand(placed) if expand else placed
    tagged = rows.withColumns({"_pid": F.spark_partition_id(), "_mono": F.monotonically_increasing_id()})
    # (partition, group) pairs: a partition holds a contiguous key range, so
    # there are at most partitions + groups - 1 of them.
    spans = (tagged.groupBy("_pid", *group_cols)
                   .agg(F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (spans.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                    .select(F.col("_pid").alias("_o_pid"),
                            *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(group_cols)],
                            "_first", "_offset"))
    join_cond = [F.col("_pid") == F.col("_o_pid")] + [
        F.col(c).eqNullSafe(F.col(f"_o_{i}")) for i, c in enumerate(group_cols)]
    out = tagged.join(F.broadcast(offsets), join_cond, "inner")
    return out.select(*rows.columns,
                      (F.col("_offset") + F.col("_mono") - F.col("_first") + 1).cast("bigint").alias(id_col))


def compat_ids(df: DataFrame, order_col: str = "extract_date", id_col: str = "id") -> DataFrame:
    """The original id: global sort, ``monotonically_increasing_id() + 1`` (not contiguous)."""
    return df.orderBy(order_col).withColumn(id_col, F.monotonically_increasing_id() + 1)


def list_ids(rows: DataFrame, group_cols: list[str], order_cols: list[str], list_col: str, id_col: str = "id") -> DataFrame:
    """Rows read from files, one for each list entry, with ids 1.. in each group; the wide rows are never sorted or checkpointed.

    Two passes.  The first takes the keys, the list's length and the row's
    place in its file, puts those narrow rows in order (range partitioned, so
    a hot group is split), writes them, and adds up the lengths inside each
    stretch and over the stretches.  The second joins each row's first id back
    by its place in the file, a key without skew, and explodes.  Ties in
    ``order_cols`` are broken by that place; null and empty lists have no ids.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spot = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    narrow = rows.select(*group_cols, *order_cols, *spot, F.greatest(F.size(list_col), F.lit(0)).cast("long").alias("_n")).where("_n > 0")
    keys = [F.col(c).asc_nulls_first() for c in [*group_cols, *order_cols, "_file", "_row"]]
    placed = (narrow.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
              .select(*group_cols, "_file", "_row", "_n", "_place", F.shiftright("_place", 33).alias("_part")))
    path = scratch_path(spark, "ids")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    stretches = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)          # one row for each partition
    starts = placed.groupBy("_part").agg(F.sum("_n").alias("_sum")).select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(stretches), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        F.broadcast(starts), F.col("_part") == F.col("_p")).withColumn("_before", F.col("_start") + F.col("_in"))
    first = before.groupBy(*[F.col(c).alias(f"_g_{c}") for c in group_cols]).agg(F.min("_before").alias("_base"))
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_cols]
    starts_of = before.join(first, same).select("_file", "_row", (F.col("_before") - F.col("_base")).alias("_first"))
    others = [F.col(f"`{c}`") for c in rows.columns if c != list_col]
    wide = rows.select("*", *spot).join(starts_of, ["_file", "_row"])
    return wide.select(*others, F.col(list_col).alias(f"{list_col}_array"), "_first", F.posexplode(list_col).alias("skill_pos", list_col)).withColumn(
        id_col, (F.col("_first") + F.col("skill_pos") + 1).cast("bigint")).drop("_first")
