"""The ledger workload as a job: read nested ``transactions`` and ``blocks``
(Parquet paths or catalog tables), build the labelled address vectors and
write them. This is what replaces the source's parameterised SQL text: the
table names, signatures, hit threshold and class caps are arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featpipe.operators.signatures import MIN_HITS, MINER_SIGNATURES
from featpipe.operators.vectors import DEFAULT_CAP, address_vectors
from featpipe.session import configure
from featpipe.sources.ledger import read_ledger


def build_vectors(spark: SparkSession, transactions: str, blocks: str, out: str | None = None,
                  signatures=MINER_SIGNATURES, min_hits: int = MIN_HITS,
                  miner_cap: int | None = DEFAULT_CAP, non_miner_cap: int | None = DEFAULT_CAP,
                  segment_unit: str = "day") -> DataFrame:
    configure(spark)
    tx, bl = read_ledger(spark, transactions, blocks)
    v = address_vectors(tx, bl, signatures, min_hits, miner_cap, non_miner_cap, segment_unit)
    if out:
        v.write.mode("overwrite").parquet(out)
        return spark.read.parquet(out)
    return v
