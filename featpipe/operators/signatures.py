"""Miner signatures: coinbase text matching (P6, P7), the block join (J2), the
hit threshold (G4), and membership as semi / NOT IN anti joins (J3, J4).

The signature set is small (one row per qualifying key) but its size is not
fixed, so no broadcast is forced: AQE broadcasts it at run time when its
measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and
sort-merges otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.functions.keys import address_key

# Hex coinbase signatures of mining pools, as listed in the
# source query (AntPool, BCMonster, BitMinter, Btcmp, Eligius, Bravo Mining,
# KanoPool, Merge Mining Pool, Slush Pool). Matching is case-sensitive.
MINER_SIGNATURES = [
    "4d696e656420627920416e74506f6f6c",
    "2f42434d6f6e737465722f",
    "4269744d696e746572",
    "2f7374726174756d2f",
    "456c6967697573",
    "2f627261766f2d6d696e696e672f",
    "4b616e6f",
    "2f6d6d706f6f6c",
    "2f736c7573682f",
]
MIN_HITS = 20


def signature_match(c, signatures) -> "F.Column":
    """Any-of substring match (``LIKE '%s%'`` per pattern)."""
    if not signatures:
        return F.lit(False)
    col = F.col(c) if isinstance(c, str) else c
    return reduce(or_, [col.contains(s) for s in signatures])


def signed_blocks(blocks: DataFrame, signatures) -> DataFrame:
    return blocks.where(signature_match("coinbase_param", signatures)).select(
        F.col("hash").alias("_block"))


def block_join(blocks: DataFrame, tx: DataFrame, signatures) -> DataFrame:
    """J2 + P6: coinbase transactions (``is_coinbase IS TRUE``) in blocks whose
    coinbase text carries a signature, unnested to one row per output key."""
    # As a filter, the bare boolean column keeps exactly the rows where it IS
    # TRUE (NULL drops), and it is pushed to the scan as is_coinbase = true.
    coinbase = tx.where(F.col("is_coinbase")).select(
        "block_hash", F.explode("outputs").alias("_x"))
    return (
        signed_blocks(blocks, signatures)
        .join(coinbase, F.col("_block") == F.col("block_hash"))
        .select(address_key(F.col("_x").getField("addresses")).alias("miner"))
    )


def signature_keys(blocks: DataFrame, tx: DataFrame, signatures=MINER_SIGNATURES,
                   min_hits: int = MIN_HITS) -> DataFrame:
    """Keys with at least ``min_hits`` signed coinbase outputs. Counts
    exploded outputs, as the source's ``HAVING COUNT(1)`` does."""
    return (
        block_join(blocks, tx, signatures)
        .groupBy("miner").agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") >= min_hits)
    )


def semi_in(df: DataFrame, key: str, keyset: DataFrame, set_key: str) -> DataFrame:
    """``key IN (SELECT set_key ...)`` as a left-semi join."""
    return df.join(keyset.select(F.col(set_key).alias("_k")), F.col(key) == F.col("_k"), "left_semi")


def anti_not_in(df: DataFrame, key: str, keyset: DataFrame, set_key: str) -> DataFrame:
    """``key NOT IN (SELECT set_key ...)`` with SQL's NULL rules, but as a
    plain (sort-merge capable) left-anti join instead of the null-aware
    broadcast one:
      * a NULL in the set makes every comparison unknown: no row survives;
      * a NULL key survives only when the set is empty.
    The two emptiness facts are scalar subqueries (one global aggregate each,
    evaluated once and used as literals in the filter).
    """
    k = F.col(set_key)
    n_rows = keyset.select(F.count(F.lit(1))).scalar()
    n_nulls = keyset.select(F.count(F.when(k.isNull(), 1))).scalar()
    kept = df.join(keyset.where(k.isNotNull()).select(k.alias("_k")),
                   F.col(key) == F.col("_k"), "left_anti")
    return kept.where((n_nulls == 0) & (F.col(key).isNotNull() | (n_rows == 0)))
