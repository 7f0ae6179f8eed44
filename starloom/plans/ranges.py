"""Global positions and ranks without a one-task window.

Rows are dealt by range and sorted in each partition once, and written to
shared storage with their partition and place. Counts and offsets are taken
from what was written, so they belong to one and the same set of ranges
however later steps prune columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import shared_dir


def stage_ranges(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` plus ``_pid`` (range) and ``_rn`` (place in the range, from 1), written once."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
              .withColumn("_rn", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_mid"))
    path = shared_dir(spark, "starloom-ranges", uuid.uuid4().hex)
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def with_offsets(staged: DataFrame) -> DataFrame:
    """``staged`` plus ``_off``, the rows in earlier ranges. One row per range is broadcast."""
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_pid", F.coalesce(earlier, F.lit(0)).alias("_off"))
    return staged.join(F.broadcast(offsets), "_pid")


def global_rank(df: DataFrame, by: Column, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus its ``rank`` (ties share one) by one sort column; equal values share a range."""
    ranged = with_offsets(stage_ranges(df, [by], partitions))
    rank = F.col("_off") + F.rank().over(Window.partitionBy("_pid").orderBy(by))
    return ranged.withColumn(name, rank.cast("int")).drop("_pid", "_rn", "_off")
