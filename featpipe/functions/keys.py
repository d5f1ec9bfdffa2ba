"""Column-expression helpers. All built-in expressions: they stay inside
whole-stage codegen and need no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def address_key(addresses) -> Column:
    """Composite party key: array elements joined by ',' with NULL elements
    skipped. A NULL array becomes the empty key '' (repeated fields in the
    source are never NULL), so the key itself is never NULL."""
    return F.array_join(F.coalesce(col_(addresses), F.array().cast("array<string>")), ",")


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch (floored), for timestamp, timestamp_ntz
    or date input; ntz and dates are read in the session zone (UTC)."""
    return F.unix_seconds(col_(c).cast("timestamp"))


def hash_bucket(token, buckets: int) -> Column:
    """Deterministic bucket in [0, buckets): first 15 hex digits of md5 as a
    non-negative bigint, modulo ``buckets``. Engine-independent, so an SQL
    oracle can reproduce it."""
    h = F.conv(F.substring(F.md5(col_(token).cast("string")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def row_fingerprint(cols, numeric_scale: int = 100) -> Column:
    """Text fingerprint of a whole row: numbers scaled by ``numeric_scale`` and
    rounded half up to bigint as ``floor(x * s + 0.5)`` (plain IEEE steps, so
    double printing never matters and other engines agree), text as is, NULL as
    the marker '\\N', fields separated by '|'."""
    parts = []
    for c, kind in cols:
        c = col_(c)
        if kind == "numeric":
            v = F.floor(c.cast("double") * float(numeric_scale) + 0.5).cast("string")
        else:
            v = c.cast("string")
        parts.append(F.coalesce(v, F.lit("\\N")))
    return F.concat_ws("|", *parts)
