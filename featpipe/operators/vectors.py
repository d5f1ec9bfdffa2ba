"""Labelled per-address behaviour vectors (C1) and their pieces: the per-side
profile, the address join (J1), the label, the per-class cap (L1) and the
union of classes (U1).

Fused plan: per side, one explode, one shuffle by (address, segment of time) and
one aggregate, whose rows are merged per address. Both sides end
hash-partitioned by address, so the output/input join and the label join line
up on the same partitioning. The label is one left
join to the signature set instead of separate IN / NOT IN branches (the key
is never NULL, so the two are the same); the set is only split for the cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featpipe.functions.distinct import bitmap_aggs, bitmap_count, fits, month_index, word_columns
from featpipe.functions.keys import epoch_seconds
from featpipe.operators.idle import idle_stats, moment_stats
from featpipe.operators.signatures import MIN_HITS, MINER_SIGNATURES, signature_keys
from featpipe.operators.transfers import epoch_features, month_range, transfer_stats, unnest_transfers
from featpipe.session import scratch_path

# Output record, in order (30 columns).
VECTOR_COLUMNS = [
    "is_miner", "address",
    "output_month_min", "output_month_max", "input_month_min", "input_month_max",
    "output_active_time", "input_active_time", "io_max_lag", "io_min_lag",
    "output_active_months", "total_tx_output_count", "total_tx_output_value", "mean_tx_output_value",
    "stddev_tx_output_value", "total_output_tx", "mean_monthly_output_value", "mean_monthly_output_count",
    "input_active_months", "total_tx_input_count", "total_tx_input_value", "mean_tx_input_value",
    "stddev_tx_input_value", "total_input_tx", "mean_monthly_input_value", "mean_monthly_input_count",
    "mean_output_idle_time", "stddev_output_idle_time", "mean_input_idle_time", "stddev_input_idle_time",
]

DEFAULT_CAP = 2000


def one_time_per_hash(tx: DataFrame) -> bool:
    """Whether every transaction hash has one block time. Then a hash is never
    counted in two segments of time. One job over two narrow columns,
    pre-aggregated by hash."""
    t = F.col("block_timestamp")
    times = tx.where("hash IS NOT NULL").groupBy("hash").agg(
        F.min(t).alias("lo"), F.max(t).alias("hi"), F.count(t).alias("n"), F.count(F.lit(1)).alias("rows"))
    return times.where("lo != hi OR (n > 0 AND n < rows)").isEmpty()


def side_profile_apart(tx: DataFrame, side: str = "outputs", segment_unit: str = "day", months=None) -> DataFrame:
    """Statistics and idle figures of one side by two aggregates over two
    explodes, joined on the address: right for any data."""
    prefix = {"outputs": "output", "inputs": "input"}[side]
    t = unnest_transfers(tx, side)
    return transfer_stats(t, prefix, months or month_range(tx)).join(
        idle_stats(t, "address", "block_time", segment_unit, prefix), "address")


def side_profile(tx: DataFrame, side: str = "outputs", segment_unit: str = "day", months=None,
                 once: bool | None = None) -> DataFrame:
    """Statistics and idle figures of one side from one explode.

    Transfers are shuffled once, by (address, segment of time), so a hot address
    spreads over its segments. Inside one they are sorted by time and hash: a
    row whose time or hash differs from the row before starts a new time or
    transaction, which gives gaps and distinct transactions without sets. One
    aggregate makes a mergeable row per (address, segment): counts, sums, the
    squared deviations from its own mean, month bounds and bits, first and last
    time. These rows, one per segment, are merged per address after a window
    that adds the gaps between segments and the shift of each segment's mean.

    Needs one block time per hash (``once``, measured when not given) and months
    that fit a bitmap; other data takes ``side_profile_apart``, which gives the
    same result. Keys need at least one gap (two distinct times), as in the
    source's inner join with idle times."""
    p = {"outputs": "output", "inputs": "input"}[side]
    months = months or month_range(tx)
    once = one_time_per_hash(tx) if once is None else once
    if not once or not months or not fits(*months):
        return side_profile_apart(tx, side, segment_unit, months)
    wide = "decimal(38,0)"
    t = unnest_transfers(tx, side).withColumn("_seg", F.date_trunc(segment_unit, "block_time")).repartition("address", "_seg")
    before = Window.partitionBy("address", "_seg").orderBy("block_time", "hash")
    t = t.withColumn("_row", F.row_number().over(before)).withColumn("_time", F.lag("block_time").over(before)).withColumn(
        "_hash", F.lag("hash").over(before))
    new_time = ~F.col("block_time").eqNullSafe(F.col("_time")) | (F.col("_row") == 1)
    gap = F.when(new_time, epoch_seconds("block_time") - epoch_seconds("_time"))
    new_tx = new_time | ~F.col("hash").eqNullSafe(F.col("_hash"))
    words = word_columns("_mw", *months)
    parts = t.groupBy("address", "_seg").agg(
        F.min("month").alias("_lo"), F.max("month").alias("_hi"), F.count("month").alias("_n_month"),
        *bitmap_aggs(month_index("month"), *months, "_mw"),
        F.count(F.when(F.col("is_transfer"), 1)).alias("_n"), F.count(F.when(F.col("has_addresses"), 1)).alias("_n_addresses"),
        F.count("value").alias("_n_value"), F.sum("value").alias("_sum"), F.var_pop("value").alias("_var"),
        F.count(F.when(new_tx, F.col("hash"))).alias("_n_tx"),
        F.min("block_time").alias("_first"), F.max("block_time").alias("_last"), F.count(gap).alias("_gaps"),
        F.coalesce(F.sum(gap.cast(wide) * gap.cast(wide)), F.lit(0).cast(wide)).alias("_sq"))
    order, whole = Window.partitionBy("address").orderBy("_seg"), Window.partitionBy("address")
    n, total = F.col("_n_value"), F.col("_sum").cast("double")
    parts = (parts.withColumn("_prev", F.lag("_last").over(order))
             .withColumn("_mean", F.sum(total).over(whole) / F.nullif(F.sum(n).over(whole), F.lit(0))))
    across = epoch_seconds("_first") - epoch_seconds("_prev")
    shift = F.when(n > 0, total / F.nullif(n, F.lit(0)) - F.col("_mean"))
    sums = parts.groupBy("address").agg(
        F.min("_lo").alias(f"{p}_month_min"), F.max("_hi").alias(f"{p}_month_max"), F.sum("_n_month").alias("_n_month"),
        *[F.bit_or(w).alias(w) for w in words],
        F.sum("_n").alias(f"total_tx_{p}_count"), F.sum("_n_addresses").alias("_n_addresses"), F.sum(n).alias("_n_value"),
        F.sum("_sum").cast("double").alias(f"total_tx_{p}_value"), F.sum("_n_tx").alias(f"total_{p}_tx"),
        F.sum(n * (F.col("_var") + shift * shift)).alias("_squares"),
        (F.sum("_gaps") + F.count(across)).alias("n_gaps"),
        (epoch_seconds(F.max("_last")) - epoch_seconds(F.min("_first"))).alias("sum_gaps"),
        (F.sum("_sq") + F.coalesce(F.sum(across.cast(wide) * across.cast(wide)), F.lit(0).cast(wide))).alias("sum_sq_gaps"),
    ).where("n_gaps > 0")
    value, n_value, n_month = F.col(f"total_tx_{p}_value"), F.col("_n_value"), F.col("_n_month")
    return sums.select(
        "address", f"{p}_month_min", f"{p}_month_max", bitmap_count("_mw", *months).alias(f"{p}_active_months"),
        f"total_tx_{p}_count", f"total_tx_{p}_value",
        F.when(n_value > 0, value / n_value).alias(f"mean_tx_{p}_value"),
        F.when(n_value > 1, F.sqrt(F.col("_squares") / (n_value - 1))).alias(f"stddev_tx_{p}_value"),
        f"total_{p}_tx", (value / n_month).alias(f"mean_monthly_{p}_value"),
        (F.col("_n_addresses") / n_month).alias(f"mean_monthly_{p}_count"),
        *moment_stats(p))


def address_join(out_side: DataFrame, in_side: DataFrame) -> DataFrame:
    """Keys present on both sides (inner equi-join on the address)."""
    return out_side.join(in_side, "address")


def unlabelled_vectors(tx: DataFrame, segment_unit: str = "day") -> DataFrame:
    months, once = month_range(tx), one_time_per_hash(tx)
    return epoch_features(address_join(side_profile(tx, "outputs", segment_unit, months, once),
                                       side_profile(tx, "inputs", segment_unit, months, once)))


def label(vectors: DataFrame, miners: DataFrame) -> DataFrame:
    """``is_miner``: membership in the signature set (a left join)."""
    m = miners.select(F.col("miner").alias("address"), F.lit(True).alias("_m"))
    return vectors.join(m, "address", "left").withColumn(
        "is_miner", F.coalesce(F.col("_m"), F.lit(False))).drop("_m")


#: Hex digits of md5 that one pass of ``class_cap`` counts: 4096 buckets.
CAP_DIGITS = 3
#: Rows of the last bucket that are sorted.
CAP_ROWS = 1000


def class_cap(vectors: DataFrame, n: int) -> DataFrame:
    """L1: ``LIMIT n`` made deterministic: the first ``n`` rows by
    (md5(address), address), for any ``n`` and without gathering ``n`` rows.

    Rows are counted by the first hex digits of md5 (4096 counts), which tells
    the bucket that the ``n``-th row lies in; that bucket is counted by the next
    digits until it is small. The result is a filter on md5, plus the first rows
    of the last bucket. ``vectors`` is read several times: give a written table."""
    digest, prefix, taken = F.md5("address"), "", 0
    below = F.lit(False)
    while len(prefix) < 32:
        width = len(prefix) + CAP_DIGITS
        part = F.substring(digest, 1, width)
        inside = vectors.where(F.substring(digest, 1, len(prefix)) == prefix) if prefix else vectors
        counts = sorted((r["part"], r["n"]) for r in inside.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        hit = next(((p, k, before) for p, k, before in _running(counts, taken) if before + k > n), None)
        if hit is None:   # everything in here is wanted
            return vectors.where(below | (F.substring(digest, 1, len(prefix)) == prefix)) if prefix else vectors
        prefix, rows, taken = hit
        below = F.substring(digest, 1, width) < prefix
        if rows <= CAP_ROWS:
            break
    last = vectors.where(F.substring(digest, 1, len(prefix)) == prefix).orderBy(digest, "address").limit(n - taken)
    return vectors.where(below).unionByName(last)


def _running(counts, before: int):
    for part, n in counts:
        yield part, n, before
        before += n


def labelled_union(vectors: DataFrame, miner_cap: int | None, non_miner_cap: int | None,
                   materialize: bool = True) -> DataFrame:
    """Capped miners UNION ALL capped non-miners.

    Both branches read ``vectors``; with ``materialize`` it is first written
    once as a table in the shared folder (one row per address), because
    Catalyst plans the two filtered branches differently and would otherwise
    run the whole upstream aggregation twice. (A reliable ``checkpoint()``
    computes its last stage twice: once for its job, once for the files.)"""
    if materialize and (miner_cap is not None or non_miner_cap is not None):
        vectors = write_table(vectors, "vectors")
    pos = vectors.where(F.col("is_miner"))
    neg = vectors.where(~F.col("is_miner"))
    if miner_cap is not None:
        pos = class_cap(pos, miner_cap)
    if non_miner_cap is not None:
        neg = class_cap(neg, non_miner_cap)
    return pos.unionByName(neg)


def address_vectors(tx: DataFrame, blocks: DataFrame, signatures=MINER_SIGNATURES,
                    min_hits: int = MIN_HITS, miner_cap: int | None = DEFAULT_CAP,
                    non_miner_cap: int | None = DEFAULT_CAP, segment_unit: str = "day") -> DataFrame:
    """The whole labelled vector query, 30 columns in source order."""
    miners = signature_keys(blocks, tx, signatures, min_hits)
    v = label(unlabelled_vectors(tx, segment_unit), miners)
    return labelled_union(v, miner_cap, non_miner_cap).select(*VECTOR_COLUMNS)


def write_table(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
