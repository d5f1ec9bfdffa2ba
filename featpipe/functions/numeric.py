"""Numeric helpers shared by queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c, digits: int) -> Column:
    """Round half up to ``digits`` places as ``floor(x * 10^d + 0.5) / 10^d``.

    Used only where two engines legitimately differ in the last bits (sample
    deviations, means of floating sums). The formula is plain IEEE arithmetic,
    so the SQL oracle can write the same text and get the same bits."""
    c = F.col(c) if isinstance(c, str) else c
    s = float(10 ** digits)
    return F.floor(c * s + 0.5) / s


def fixed_sql(expr: str, digits: int) -> str:
    """The oracle-side twin of ``fixed``."""
    s = float(10 ** digits)
    return f"(floor(({expr}) * {s} + 0.5) / {s})"
