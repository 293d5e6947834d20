"""Numbering the rows of a whole table in order, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import checkpointed


def numbered(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with ``name`` = 1, 2, ... along ``order``, which should be total.

    Rows are sorted in ranges, each range is counted, and the counts before it are its offset: a row a range is all
    that comes together.  The ranges are written down once, as they are drawn from a sample of the rows."""
    ranges = checkpointed(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranges.join(F.broadcast(offsets), "__range").withColumn(name, (own + F.col("__before")).cast("long")).drop("__range", "__before")
