"""Registered queries of the operators: whole tables in, full results out.

Each query calls its operator with production parameters and derives the
columns of its contract from what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featpipe.llm import (
    decontaminate, fingerprints, jaccard, language, lines, mixing, quality, resampling, search, sharding, substrings, tokens,
    warc,
)
from featpipe.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to dictionary-compressed archives and read back."""
    return (warc.archive_pages(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to target weights by source; the target in thousandths of a word."""
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", (F.floor(F.col("target") * 1000 + 0.5) / 1000).alias("target"),
                    "taken"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 5-word shingle Jaccard of 0.75."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and benchmark items that overlap: (doc_id, item_id) with the best place."""
    return (decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "matched", "compared", "first", "hits"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, by k-d tree."""
    sharded = sharding.with_slots(sharding.shard(table(spark, sf_dir, "documents"), n_shards=24))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after passages of 50 words or more that an earlier document has."""
    return (substrings.remove_repeats(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under byte_bpe_50k.json, by compiled transducers."""
    import public_tokenizers
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text: script ranges, word scores, Viterbi."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that repeat an earlier line, exactly or nearly."""
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and hashed n-gram log-likelihood ratio of every document."""
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every benchmark item, by dense products."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their edited texts, classes and near groups."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents drawn towards the benchmark's n-gram distribution."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_language": op8_language,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_fingerprints": op12_fingerprints,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE: dict[str, str] = {
    "op1_warc": warc.ORACLE,
    "op2_mixing": mixing.ORACLE,
    "op11_ranked_search": search.ORACLE,
    "op13_importance_resampling": resampling.ORACLE,
}
