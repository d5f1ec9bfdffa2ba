"""Running totals over a range sort, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featpipe.session import scratch_path


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_totals(df: DataFrame, groups: list[str], order: list, amount: str, name: str, out: str = "upto") -> DataFrame:
    """``df`` with ``out``: the sum of ``amount`` over the rows of the same
    ``groups`` up to and with this one, in ``order`` (columns, or columns with a direction).

    The rows are range-partitioned by (groups, order) and written once with
    their partition's number, so a group of any size spans many partitions. A
    group's piece of a partition is summed; a window over the pieces (at most
    one row per partition) gives each its offset, and a window inside the piece
    adds the rest. Groups must not be NULL; rows that tie in all of ``order``
    come in any order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = write_once(df.repartitionByRange(parts, *groups, *order).withColumn("_part", F.spark_partition_id()), name)
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (rows.groupBy(*groups, "_part").agg(F.sum(amount).alias("_sum"))
              .select(*groups, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy(*groups, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(pieces, [*groups, "_part"]).withColumn(out, F.col("_offset") + F.sum(amount).over(inside))
            .drop("_offset", "_part"))
