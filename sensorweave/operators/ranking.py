"""Position of each row within its group, robust to a group holding most rows.

``row_number() over (partition by g order by o)`` sends a whole group to one
task, which buffers it.  Here the rows are range-partitioned on (g, o), so a
large group is cut into consecutive segments on many tasks; each row's rank is
its offset inside its segment plus the sizes of the group's earlier segments.
The segment table has one row per (task, group), so the only window left runs
over at most ``#partitions`` rows per group.  The partitioned rows are
checkpointed once so that both passes over them agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


COUNTED = 65_536


def rank_within_group(df: DataFrame, group: list[str], order: list[str],
                      partitions: int | None = None) -> DataFrame:
    """Adds ``rank`` (1-based, by ``order``) and ``group_size`` to every row.

    ``group + order`` must be a total order (ties would make ranks arbitrary).
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    s = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    # Both passes below must see the same partitioning: a second range shuffle
    # would sample its own bounds.  A reliable checkpoint (shared folder) pins
    # the rows, their task ids and positions once, and survives executor loss.
    ensure_checkpoint_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    seg = s.groupBy("_pid", *group).agg(F.min("_mid").alias("_m0"), F.count("*").alias("_c"))
    by_group = Window.partitionBy(*group)
    seg = seg.select(
        "_pid", *group, "_m0",
        F.coalesce(F.sum("_c").over(by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_c").over(by_group).alias("group_size"))
    out = s.join(seg, ["_pid", *group])
    return out.select(*df.columns, (F.col("_mid") - F.col("_m0") + F.col("_off") + 1).alias("rank"),
                      "group_size")


def numbered(df: DataFrame, group: list[str], order: list[str], most: int = 100_000) -> DataFrame:
    """As ``rank_within_group``; where no group is measured to have more than ``most`` rows, by one shuffle on the group."""
    def largest(*keys):
        largest, rows = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
        return largest or 0, rows or 0

    # no group is larger than all groups of its hash together, and these counts move next to nothing; groups
    # are counted one by one only where there are so many rows that many small groups may share a hash
    together, all_rows = largest(F.pmod(F.xxhash64(*group), F.lit(COUNTED)))
    if together > most and (all_rows <= most * (COUNTED // 16) or largest(*group)[0] > most):
        return rank_within_group(df, group, order)
    rows = Window.partitionBy(*group).orderBy(*order)
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # in the same pass as the ranks
    return df.select(*df.columns, F.row_number().over(rows).cast("long").alias("rank"), F.count("*").over(whole).alias("group_size"))
