"""Per-side transfer operators of the ledger query: unnest (A1-A3), activity
ages (G1) and transfer statistics (G2a-f).

Every aggregate here is a ``groupBy`` with partial (map-side) aggregation, so a
key that owns a large share of all transfers is pre-reduced on every mapper
before the shuffle. The one distinct aggregate (transactions) is planned by
Spark as a two-level aggregate keyed first on (address, hash), which spreads a
hot address over its transactions; distinct months use a bitmap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.functions.distinct import bitmap_aggs, bitmap_count, fits, month_index, word_columns
from featpipe.functions.keys import address_key, epoch_seconds


def unnest_transfers(tx: DataFrame, side: str = "outputs") -> DataFrame:
    """A1-A3: one row per element of ``tx[side]`` (inner unnest: rows with an
    empty or NULL array vanish), keyed by the joined address string.

    Columns: address, value, hash, block_time, month, is_transfer (element not
    NULL), has_addresses (its address array not NULL).
    """
    x = F.col("_x")
    return (
        tx.select("hash", "block_timestamp", "block_timestamp_month", F.explode(side).alias("_x"))
        .select(
            address_key(x.getField("addresses")).alias("address"),
            x.getField("value").alias("value"),
            F.col("hash"),
            F.col("block_timestamp").alias("block_time"),
            F.col("block_timestamp_month").alias("month"),
            x.isNotNull().alias("is_transfer"),
            x.getField("addresses").isNotNull().alias("has_addresses"),
        )
    )


def activity_ages(transfers: DataFrame, prefix: str = "output") -> DataFrame:
    """G1: first and last active month per address."""
    return transfers.groupBy("address").agg(
        F.min("month").alias(f"{prefix}_month_min"),
        F.max("month").alias(f"{prefix}_month_max"),
    )


def month_range(tx: DataFrame, month: str = "block_timestamp_month"):
    """(lo, hi) month index of a date column when all its dates fall on one
    day of the month, else None: only then do distinct months and distinct
    dates count the same. One small job reading a single date column; the
    range is a superset of the months of any side's transfers."""
    d = F.col(month)
    r = tx.agg(F.min(d).alias("lo"), F.max(d).alias("hi"),
               (F.min(F.dayofmonth(d)) == F.max(F.dayofmonth(d))).alias("one_day")).first()
    if r["lo"] is None or not r["one_day"]:
        return None
    return r["lo"].year * 12 + r["lo"].month - 1, r["hi"].year * 12 + r["hi"].month - 1


def transfer_stats(transfers: DataFrame, prefix: str = "output", months=None) -> DataFrame:
    """G1 + G2 in one aggregation per address.

    Distinct transactions use ``count_distinct``: Spark plans a two-level
    aggregate whose first shuffle is keyed by (address, hash), which spreads a
    hot address over its transactions; every level combines map-side.
    Active months are the distinct values of the month column, whatever dates
    it holds. Where every date falls on the same day of its month, months stand
    for dates, and a bitmap over the measured month range (``months`` = (lo,
    hi) month index, measured here when not given) counts them: it is merged
    like any other partial aggregate, so no Expand (a copy of every row per
    distinct aggregate) is needed. Other dates are counted by
    ``count_distinct``; both give the same number. The two "monthly" means divide by the row count of
    months, as the source does. Sums stay decimal and are cast to double once;
    the mean is sum / count.
    """
    p = prefix
    if months is None:
        months = month_range(transfers, "month")
    use_bits = fits(*months) if months else False
    month_aggs = (bitmap_aggs(month_index("month"), months[0], months[1], "_mw") if use_bits
                  else [F.count_distinct("month").alias(f"{p}_active_months")])
    value_sum = F.sum("value")
    n_month = F.count("month")
    agg = transfers.groupBy("address").agg(
        F.min("month").alias(f"{p}_month_min"),
        F.max("month").alias(f"{p}_month_max"),
        *month_aggs,
        F.count(F.when(F.col("is_transfer"), 1)).alias(f"total_tx_{p}_count"),
        value_sum.cast("double").alias(f"total_tx_{p}_value"),
        (value_sum.cast("double") / F.nullif(F.count("value"), F.lit(0))).alias(f"mean_tx_{p}_value"),
        F.stddev_samp("value").alias(f"stddev_tx_{p}_value"),
        F.count_distinct("hash").alias(f"total_{p}_tx"),
        (value_sum.cast("double") / n_month).alias(f"mean_monthly_{p}_value"),
        (F.count(F.when(F.col("has_addresses"), 1)) / n_month).alias(f"mean_monthly_{p}_count"),
    )
    if use_bits:
        words = word_columns("_mw", *months)
        agg = agg.withColumn(f"{p}_active_months", bitmap_count("_mw", *months)).drop(*words)
        cols = [c for c in agg.columns]
        cols.remove(f"{p}_active_months")
        cols.insert(3, f"{p}_active_months")
        agg = agg.select(*cols)
    return agg


def epoch_features(df: DataFrame) -> DataFrame:
    """Month bounds as epoch seconds plus spans and output-minus-input
    lags, from a frame holding output/input month min/max as dates."""
    s = {c: epoch_seconds(c) for c in
         ("output_month_min", "output_month_max", "input_month_min", "input_month_max")}
    return df.select(
        *[c for c in df.columns if c not in s],
        *[v.alias(k) for k, v in s.items()],
        (s["output_month_max"] - s["output_month_min"]).alias("output_active_time"),
        (s["input_month_max"] - s["input_month_min"]).alias("input_active_time"),
        (s["output_month_max"] - s["input_month_max"]).alias("io_max_lag"),
        (s["output_month_min"] - s["input_month_min"]).alias("io_min_lag"),
    )
