"""Distributed prefix sums over a range-sorted table, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featpipe.llm.common import partitions, written


def prefix_sums(df: DataFrame, group: str, order: list[str], value: str, name: str,
                before: str = "before") -> DataFrame:
    """``df`` with the column ``before``: the sum of ``value`` over the rows of
    the same ``group`` that come earlier in ``order``.

    The rows are range-partitioned by (group, order) and written once with
    their partition number, so a group holding a third of all rows spans many
    partitions. Each (group, partition) piece is summed; a window over these
    sums (at most one row per piece) gives every piece its offset; a window
    inside each piece adds the local part. ``group`` must not be null. Rows
    equal in every ordering column may come in either order.
    """
    parts = partitions(df.sparkSession)
    keys = [group, *order]
    rows = written(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), name)
    pieces = rows.groupBy(group, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(pieces, [group, "_part"])
            .withColumn(before, F.col("_offset") + F.coalesce(F.sum(value).over(local), F.lit(0)))
            .drop("_offset", "_part"))
