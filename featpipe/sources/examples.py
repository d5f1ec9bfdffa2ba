"""S3 deterministic train/eval split and S4 example storage.

The split is a pure function of the row's content: md5 bucket of a row
fingerprint that covers every column (the driver's ``lineitem`` has no unique
key), 2 of 3 buckets -> ``train``. Unlike ``randomSplit`` it does not depend on
partitioning or task retries, so a lost executor recomputes the same split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featpipe.functions.keys import hash_bucket, row_fingerprint

SPLIT_BUCKETS = 3
TRAIN_BUCKETS = 2


def _kinds(df: DataFrame):
    out = []
    for f in df.schema.fields:
        kind = "numeric" if isinstance(f.dataType, T.NumericType) else "text"
        out.append((F.col(f"`{f.name}`"), kind))
    return out


def split_column(df: DataFrame, numeric_scale: int = 100) -> "F.Column":
    b = hash_bucket(row_fingerprint(_kinds(df), numeric_scale), SPLIT_BUCKETS)
    return F.when(b < TRAIN_BUCKETS, F.lit("train")).otherwise(F.lit("eval"))


def hash_split(df: DataFrame, numeric_scale: int = 100) -> DataFrame:
    """Numbers enter the hash scaled by ``numeric_scale`` and rounded: 100
    keeps two decimals; give more for data that differ beyond them."""
    return df.withColumn("split", split_column(df, numeric_scale))


def write_examples(df: DataFrame, path: str) -> str:
    """Materialise examples partitioned by ``split``; reading one split back
    prunes the other partition directory."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_examples(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def fingerprint_sql(cols_kinds, scale: int = 100) -> str:
    """DuckDB twin of ``row_fingerprint`` + ``hash_bucket`` for the oracle."""
    parts = []
    for c, kind in cols_kinds:
        if kind == "numeric":
            v = f"CAST(CAST(floor(CAST({c} AS DOUBLE) * {float(scale)} + 0.5) AS BIGINT) AS VARCHAR)"
        else:
            v = f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce({v}, '\\N')")
    return "concat_ws('|', " + ", ".join(parts) + ")"


def bucket_sql(expr: str, buckets: int) -> str:
    return f"(CAST(('0x' || substr(md5({expr}), 1, 15)) AS BIGINT) % {buckets})"


def split_sql(cols_kinds) -> str:
    return (f"CASE WHEN {bucket_sql(fingerprint_sql(cols_kinds), SPLIT_BUCKETS)} < {TRAIN_BUCKETS} "
            "THEN 'train' ELSE 'eval' END")
