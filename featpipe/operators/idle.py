"""Idle times between consecutive events of a key.

Semantics: order a key's events by time and take ``t - lag(t)``; rows whose
previous time is NULL or equal to their own are dropped, and the gap is the
difference of *floored* epoch seconds. With ties removed this is exactly one
gap per distinct timestamp after the first: the difference to the previous
distinct timestamp.

Plan (skew-safe replacement for one LAG window per key, which would put a hot
key's whole history into one task). Nothing is collected into arrays:
  1. distinct event times of each key, pre-aggregated on the mappers;
  2. their number per whole second. Times inside one second have equal floored
     seconds, so a second with ``c`` distinct times holds ``c - 1`` gaps of 0
     and adds nothing to the sums: (count, first, last) says all of it;
  3. ``units`` lists coarser time units from fine to coarse, e.g. ``("day",)``
     or ``("minute", "day")``. For each, a window partitioned by (key, coarse
     segment) over the finer segments' summaries gives the gaps across them;
     its partitions hold at most (coarse / fine) rows, e.g. 86400 seconds a day;
  4. a last window partitioned by key over the coarsest segments gives the
     remaining gaps; its partitions hold one row per coarse segment.

``idle_stats`` never materialises the gaps: a segment carries its gap count,
its sum of squared gaps (whole seconds, exact in decimal(38,0)), and its first
and last second; the gap sum of any span telescopes to last - first. Mean and
sample deviation come from these exact integer moments. Every aggregate after
a window reuses the window's partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featpipe.functions.keys import epoch_seconds

WIDE = "decimal(38,0)"


def _zero():
    return F.lit(0).cast(WIDE)


def _units(units) -> tuple:
    return (units,) if isinstance(units, str) else tuple(units)


def _sq(c):
    return c.cast(WIDE) * c.cast(WIDE)


def _dealt(summ: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by ``columns`` to all shuffle partitions. They are not merged into fewer: the rows of a task
    are sorted and then counted in its memory, many times their size in the shuffle."""
    return summ.repartition(int(summ.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _seconds(events: DataFrame, key: str, t: str) -> DataFrame:
    """(key, _seg, _n) per whole second with an event; its first and last second are itself."""
    times = events.where(F.col(t).isNotNull()).select(key, F.col(t).alias("_t")).distinct()
    return times.groupBy(key, F.date_trunc("second", "_t").alias("_seg")).agg((F.count(F.lit(1)) - 1).alias("_n"))


def _spans(seconds: DataFrame) -> DataFrame:
    """Seconds as segments: with their first and last second, and no gap inside but those of 0."""
    return seconds.select("*", F.col("_seg").alias("_first"), F.col("_seg").alias("_last"), _zero().alias("_s2"))


def _roll_up(summ: DataFrame, key: str, unit: str) -> DataFrame:
    """Merge finer segment summaries into ``unit`` segments, adding the gaps
    between consecutive finer segments inside each coarse one."""
    up = _dealt(summ.withColumn("_up", F.date_trunc(unit, F.col("_seg"))), key, "_up")
    up = up if "_first" in up.columns else _spans(up)   # seconds are moved without what follows from them
    w = Window.partitionBy(key, "_up").orderBy("_seg")
    x = up.withColumn("_prev_last", F.lag("_last").over(w))
    b = epoch_seconds("_first") - epoch_seconds("_prev_last")     # NULL on the first finer segment
    return x.groupBy(key, "_up").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        (F.sum("_n") + F.count(b)).alias("_n"),
        (F.sum("_s2") + F.coalesce(F.sum(_sq(b)), _zero())).alias("_s2"),
    ).withColumnRenamed("_up", "_seg")


def idle_moments(events: DataFrame, key: str = "address", t: str = "block_time",
                 units=("day",)) -> DataFrame:
    """``(key, n_gaps, sum_gaps, sum_sq_gaps)`` with exact integer sums; keys
    without a gap have no row."""
    units = _units(units)
    summ = _seconds(events, key, t)
    for u in units:
        summ = _roll_up(summ, key, u)
    summ = summ if "_first" in summ.columns else _spans(summ)
    w = Window.partitionBy(key).orderBy("_seg")
    x = _dealt(summ, key).withColumn("_prev_last", F.lag("_last").over(w))
    b = epoch_seconds("_first") - epoch_seconds("_prev_last")
    agg = x.groupBy(key).agg(
        (F.sum("_n") + F.count(b)).alias("n_gaps"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        (F.sum("_s2") + F.coalesce(F.sum(_sq(b)), _zero())).alias("sum_sq_gaps"),
    )
    return agg.where(F.col("n_gaps") > 0).select(
        key, "n_gaps", (epoch_seconds("_last") - epoch_seconds("_first")).alias("sum_gaps"), "sum_sq_gaps")


def idle_stats(events: DataFrame, key: str = "address", t: str = "block_time",
               units=("day",), prefix: str = "output") -> DataFrame:
    """Mean and sample deviation of the gaps per key (NULL deviation for a
    single gap)."""
    return idle_moments(events, key, t, units).select(key, *moment_stats(prefix))


def moment_stats(prefix: str):
    """Mean and sample deviation from ``n_gaps``, ``sum_gaps`` and ``sum_sq_gaps``."""
    n, s1, s2 = F.col("n_gaps"), F.col("sum_gaps"), F.col("sum_sq_gaps")
    # (n * S2 - S1^2) is exact in decimal(38,0); one rounding when divided
    num = (n.cast(WIDE) * s2 - s1.cast(WIDE) * s1.cast(WIDE)).cast("double")
    # n is never 0; no division by 0 where there is one gap
    var = num / F.nullif(n.cast("double") * (n - 1).cast("double"), F.lit(0.0))
    return [
        (s1.cast("double") / n).alias(f"mean_{prefix}_idle_time"),
        F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias(f"stddev_{prefix}_idle_time"),
    ]


def idle_gaps(events: DataFrame, key: str = "address", t: str = "block_time",
              units=("day",)) -> DataFrame:
    """One row ``(key, idle_time)`` per kept gap (bigint seconds): the zeros
    inside seconds, plus the gaps between consecutive segments at every level
    of ``units``."""
    summ = _seconds(events, key, t)
    # at most one zero per microsecond of a second
    parts = [summ.where("_n > 0").select(key, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_k"))
             .select(key, F.lit(0).cast("bigint").alias("idle_time"))]
    summ = _spans(summ).select(key, "_seg", "_first", "_last")
    for u in [*_units(units), None]:
        part = [key] if u is None else [key, F.date_trunc(u, F.col("_seg"))]
        w = Window.partitionBy(*part).orderBy("_seg")
        x = summ.withColumn("_prev_last", F.lag("_last").over(w))
        parts.append(x.where(F.col("_prev_last").isNotNull()).select(
            key, (epoch_seconds("_first") - epoch_seconds("_prev_last")).alias("idle_time")))
        if u is not None:
            summ = summ.groupBy(key, F.date_trunc(u, F.col("_seg")).alias("_seg")).agg(
                F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def idle_gaps_window(events: DataFrame, key: str = "address", t: str = "block_time") -> DataFrame:
    """Plain LAG form (one window per key). Only for small inputs
    and tests: a key's whole history lands in one task."""
    w = Window.partitionBy(key).orderBy(t)
    return (
        events.select(key, F.col(t).alias("_t"), F.lag(t).over(w).alias("_prev"))
        .where(F.col("_t") != F.col("_prev"))
        .select(key, (epoch_seconds("_t") - epoch_seconds("_prev")).alias("idle_time"))
    )
