"""Exact rank within a group without gathering the group in one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task: a group holding a third of the data would sort a third of the
data in one place.  ``ordered_rank`` computes the same numbers in a way that
spreads a hot group over many tasks:

1. range-partition on (g, o) -- the sampled bounds split a hot group across
   many partitions -- and sort inside each partition;
2. tag rows with ``monotonically_increasing_id`` (increasing within a
   partition, so a group's rows in one partition are consecutive), and
   write the tagged rows as a Parquet table into the cluster's shared
   checkpoint folder: range bounds are sampled per execution, so the tags
   must be fixed once and read back by both of the following steps;
3. per (partition, group): first id and row count -- a small table with at
   most (#partitions + #groups) rows;
4. a running sum of those counts over earlier partitions of the same group
   gives each (partition, group) its offset;
5. rank = id - first id + 1 + offset, joined back on (partition, group); the
   planner chooses the join (a hot group is spread over its partitions).

The order should be unique within a group (add a key as the last tie-break)
so the ranks are fully determined by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotaxa.functions.joins import null_safe_condition
from geotaxa.session import ensure_checkpoint_dir, materialize


def ordered_rank(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                 out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its group, ordered by
    ``order_cols`` ascending (NULLs first, as Spark's ASC).  With no group
    columns it is a global row number, still computed by many tasks."""
    groups = list(group_cols)
    keys = groups + list(order_cols)
    ensure_checkpoint_dir(df.sparkSession)
    # The range partitioner samples its input in a job of its own: persist the
    # input so that job and the shuffle read it once, until the checkpoint
    # holds the tagged rows.
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    # Without an explicit count AQE may merge adjacent small range partitions;
    # the sort inside each partition keeps every group's rows contiguous, so
    # the ranks stay exact.
    by_range = (src.repartitionByRange(num_partitions, *keys) if num_partitions
                else src.repartitionByRange(*keys))
    ranged = (by_range
                .sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "rank")
    src.unpersist(blocking=False)
    stats = (ranged.groupBy("_pid", *groups)
                   .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt")))
    earlier = (Window.partitionBy(*groups).orderBy("_pid")
                     .rowsBetween(Window.unboundedPreceding, -1))
    offsets = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
    offsets = offsets.select(F.col("_pid").alias("_opid"),
                             *[F.col(g).alias(f"_o_{g}") for g in groups],
                             "_first", "_off")
    cond = ranged["_pid"] == offsets["_opid"]
    if groups:
        cond = cond & null_safe_condition(ranged, offsets, groups, [f"_o_{g}" for g in groups])
    joined = ranged.join(offsets, cond, "inner")
    rank = (F.col("_mid") - F.col("_first") + F.lit(1) + F.col("_off")).cast("long")
    return joined.withColumn(out, rank).drop(
        "_pid", "_mid", "_opid", "_first", "_off", *[f"_o_{g}" for g in groups])


def batch_ids(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
              batch_size: int, out: str = "b") -> DataFrame:
    """Batches of ``batch_size`` consecutive rows inside each group:
    ``floor((rank - 1) / batch_size)``."""
    ranked = ordered_rank(df, group_cols, order_cols, out="_rank")
    return ranked.withColumn(out, F.floor((F.col("_rank") - 1) / F.lit(batch_size)).cast("long")).drop("_rank")
