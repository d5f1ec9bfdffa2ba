"""Exact distinct counts of values from a small known integer range.

``count_distinct`` next to a second distinct aggregate makes Spark plan an
Expand (one copy of every row per distinct group) before the first shuffle.
For a value whose range is small (the months of a ledger's life) the set of
seen values fits in a few words: ``bit_or`` of one bit per value, merged
map-side by the ordinary hash aggregate, counted with ``bit_count``. The range
is measured from the data, so the count is exact for any input; a range wider
than ``MAX_WORDS`` words falls back to ``count_distinct``.

Words hold 63 values each so that every bit is ``pow(2, k)`` with k <= 62,
exact as a bigint.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 63
MAX_WORDS = 64


def month_index(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c) * 12 + F.month(c) - 1


def value_range(df: DataFrame, index: Column):
    r = df.select(F.min(index).alias("lo"), F.max(index).alias("hi")).first()
    return r["lo"], r["hi"]


def n_words(lo: int, hi: int) -> int:
    return (hi - lo) // BITS + 1


def fits(lo, hi) -> bool:
    return lo is not None and hi is not None and n_words(lo, hi) <= MAX_WORDS


def bitmap_aggs(index: Column, lo: int, hi: int, prefix: str) -> list[Column]:
    """Aggregate expressions: word ``w`` is the ``bit_or`` of ``2^(v-lo-63w)``
    over the values ``v`` of ``index`` falling in it (NULLs ignored)."""
    rel = (index - F.lit(lo)).cast("int")
    # a value outside [lo, hi] would set no bit and be lost: fail instead
    rel = F.when((rel < 0) | (rel > hi - lo),
                 F.raise_error(F.lit(f"value outside the measured range [{lo}, {hi}]")).cast("int")
                 ).otherwise(rel)
    word = F.floor(rel / BITS)
    bit = F.pow(F.lit(2.0), (rel % BITS).cast("double")).cast("bigint")
    return [F.bit_or(F.when(word == w, bit)).alias(f"{prefix}{w}") for w in range(n_words(lo, hi))]


def bitmap_count(prefix: str, lo: int, hi: int) -> Column:
    """Number of set bits over the words made by ``bitmap_aggs``."""
    return reduce(add, [F.coalesce(F.bit_count(F.col(f"{prefix}{w}")), F.lit(0))
                        for w in range(n_words(lo, hi))]).cast("bigint")


def word_columns(prefix: str, lo: int, hi: int) -> list[str]:
    return [f"{prefix}{w}" for w in range(n_words(lo, hi))]
