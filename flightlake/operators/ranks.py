"""Exact ranks in groups of any size.

Rows are range-partitioned and sorted by (group, order), so a large group spans many tasks, and
written to the shared checkpoint folder, so that every later use sees the same ranges. Inside a
partition a running sum numbers the rows; the sums of the partitions before, a table of one row per
(partition, group), are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import shared_root


def with_sum_before(df: DataFrame, group_cols, order_cols, weight: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``weight`` over the rows of the same group that come earlier.

    Rows should be distinct in (group, order): many equal ones would share a partition. Null group
    values form a group. The sorted rows are written out when this is called.
    """
    spark = df.sparkSession
    shared_root(spark)
    groups, orders = list(group_cols), list(order_cols)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *groups, *orders).withColumn("__pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    upto = Window.partitionBy("__pid", *groups).orderBy(*orders).rowsBetween(Window.unboundedPreceding, -1)
    here = ranged.withColumn("__here", F.coalesce(F.sum(weight).over(upto), F.lit(0)))
    sums = ranged.groupBy("__pid", *groups).agg(F.sum(weight).alias("__s"))
    earlier = Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("__pid").alias("__opid"), *[F.col(g).alias(f"__o_{g}") for g in groups],
                          F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__off"))
    same = F.col("__pid") == F.col("__opid")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__o_{g}"))
    return here.join(offsets, same).select(*df.columns, (F.col("__off") + F.col("__here")).alias("before"))
