"""Helpers shared by the operators: words, hashes, written tables, checked broadcasts."""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featpipe.session import scratch_path

#: A word: a maximal run of anything but space, tab, line feed, vertical tab, form feed and
#: carriage return. ``bytes.split()`` splits at exactly the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: What parts words of letters and digits, in Java's pattern language: the same as
#: ``[^\p{L}\p{N}]+``, with a plain range for ASCII, which is looked up several times faster.
BETWEEN_WORDS = r"[\x00-/:-@\[-`{-\x7F[^\x00-\x7F\p{L}\p{N}]]+"

#: Characters of scripts that do not part words by spaces: each is a token of its own.
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"

#: Odd multipliers for polynomial hashes modulo 2**64.
BASE_A = np.uint64(0x9E3779B97F4A7C15)
BASE_B = np.uint64(0xC2B2AE3D27D4EB4F)

#: Words remembered by a task before it starts its table anew.
MEMO_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: later uses
    neither recompute it nor depend on executors that are gone."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checked_broadcast(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 16 << 20) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows and
    about ``max_bytes`` bytes; otherwise return it as it is, so that the
    planner joins by shuffle."""
    width = F.lit(16 + 8 * len(df.columns)).cast("long")
    for c, kind in df.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith("array<"):
            width = width + 8 * kind.count(":") * F.coalesce(F.size(c), F.lit(0)) + 8 * F.coalesce(F.size(c), F.lit(0))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (xor-shift and multiply), so that sums of
    products become evenly spread hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across tasks."""
    return sys.modules.setdefault("_featpipe_worker", types.ModuleType("_featpipe_worker")).__dict__


class WordCodes(dict):
    """Word (bytes) -> 64-bit hash, remembered while the task runs."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        code = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = code
        return code

    def codes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def ngram_hashes(codes: np.ndarray, n: int, base: np.uint64 = BASE_A) -> np.ndarray:
    """Hash of every ``n`` consecutive codes; empty when there are fewer."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    if n <= 8:
        h = codes[:m].copy()
        for k in range(1, n):
            h = h * base + codes[k:k + m]
        return mix(h)
    # long windows: differences of prefix sums of code * base**i, moved to a
    # common power with the inverse of the base (odd, so invertible)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(codes), base, dtype=np.uint64))), dtype=np.uint64)
    back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(m, inverse, dtype=np.uint64))), dtype=np.uint64)
    total = np.concatenate(([np.uint64(0)], np.cumsum(codes * power[:-1], dtype=np.uint64)))
    return mix((total[n:] - total[:m]) * back[:m])


def batches_by_size(batch, column: int, limit: int):
    """Slices of an Arrow batch whose binary column holds about ``limit``
    bytes each (one row at least)."""
    import pyarrow.compute as pc
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast("int64"))
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end
