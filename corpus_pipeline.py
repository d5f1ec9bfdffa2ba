"""Corpus pipeline: five stages from raw documents to shards of a mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and rereads it as the next stage's documents. All but the last
return the columns of ``documents``.

Every stage takes nulls in any column, empty and very long texts, repeated rows, an
empty table and further columns of any name (which it drops); its docstring says
what becomes of them.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from featpipe.llm import decontaminate, jaccard, mixing, quality, sharding  # noqa: E402
from featpipe.llm.common import table, written  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio.

    Null and empty texts fail the base rules (fewer than 50 words). Rows repeated in
    full share their verdict; long texts are judged whole."""
    return quality.accepted(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    A null id is larger than any other; ties in id go by a hash of the text, and of
    rows repeated in id and text one stays. Texts without words are linked with
    nothing and stay."""
    docs = docs.select(*COLUMNS)
    return jaccard.one_of_each(docs, jaccard.jaccard_components(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    Null and empty texts hold none and stay; rows repeated in id and text go
    together; null ids go by their texts. Long texts are seeded at every position."""
    docs = docs.select(*COLUMNS)
    return decontaminate.clean_documents(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights, documents repeated for further epochs.

    Texts without words have no size and are left out. A null source is a source of
    its own, the last one; ties in the order inside a source are rows repeated in
    id and text, which are taken alike."""
    return mixing.mixture(docs.select(*COLUMNS))


def kd_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and bytes.

    Null texts count 8 bytes; null ids, sources and languages are values of their
    own; copies of a text go to one shard unless they outweigh a unit."""
    return sharding.shard(docs.select(*COLUMNS), n_shards=SHARDS, keep=tuple(COLUMNS))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", kd_sharding),
]

#: The log-likelihood ratio and the component search have no SQL form; tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
