"""Position of each row inside its group, without a per-group window.

``Window.partitionBy(g).orderBy(o)`` sends a whole group to one task; with
few groups (12 specialties) or one hot group that task holds a large share
of the table.  Here the rows are range-partitioned on ``(group, order)``
(sampled boundaries, so a large group is split over many tasks), sorted
within each task, and numbered locally; per-task, per-group row counts
(at most #tasks + #groups rows) give each task's starting offset.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.session import ensure_checkpoint_dir


def row_number_within(df: DataFrame, group: list[str], order: list[Column],
                      alias: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` computed with
    a range-partitioned sort.  ``order`` must make rows unique inside a group
    (then it also equals ``rank()``)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group] + list(order)
    placed = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Both branches below must see the same placement.  Column pruning would
    # otherwise give each branch its own range shuffle (separately sampled
    # bounds), so the placed rows are written once to the shared checkpoint
    # folder; this also cuts the lineage before the join.
    ensure_checkpoint_dir(spark)
    placed = placed.checkpoint(eager=True)
    # local position: ids are consecutive inside a task in sorted order
    counts = (placed.groupBy("_pid", *group)
              .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first")))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
               .select("_pid", *group, "_first", "_before"))
    # one row per (task, group) pair present, at most #tasks + #groups: the join's strategy is
    # left to the measured bytes
    return (placed.join(offsets, ["_pid", *group])
            .withColumn(alias, (F.col("_before") + F.col("_mid") - F.col("_first") + F.lit(1)).cast("bigint"))
            .drop("_pid", "_mid", "_first", "_before"))
