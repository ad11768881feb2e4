"""A global row number without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountlens.sources.storage import Scratch


def global_rank(df: DataFrame, order: Sequence[Column], carry: Sequence[str], name: str,
                scratch: Scratch, ranges: int | None = None) -> DataFrame:
    """``carry`` columns plus ``name``: 1 for the first row in ``order``, 2 for the next, ...

    Rows are split into contiguous ranges of the order, ranked inside their range, and shifted by
    the number of rows in earlier ranges. The range number is written with the rows, so a lost
    executor cannot move a row to another range. ``order`` must be total.
    """
    # Without a number of ranges Spark may merge neighbouring small ones, which keeps the order.
    spread = [ranges, *order] if ranges else list(order)
    split = scratch.save(
        df.select(*carry).repartitionByRange(*spread).withColumn("__range", F.spark_partition_id()),
        f"rank_{name}",
    )
    # One row per range: at most as many as shuffle partitions, whatever the size of the input.
    sizes = split.groupBy("__range").agg(F.count("*").alias("__size"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (
        split.withColumn("__inside", inside)
        .join(F.broadcast(offsets), "__range")
        .select(*carry, (F.col("__offset") + F.col("__inside")).cast("bigint").alias(name))
    )
