"""CSV directory source with header and a per-column type rule.

Every column is read as text, then one aggregation decides its type: all
non-empty values are written as whole numbers and fit 64 bits -> ``bigint``;
else all are written as decimal numbers -> ``double``; else ``string``.
(Spark's own ``inferSchema`` also produces timestamps and 32-bit ints, which
the rule does not have.) Only digits, a sign, a point and an exponent make a
number: ``1d``, ``NaN`` and ``Infinity`` are text. The decision is one row of
counts, so the scan is read twice: once to decide, once to cast, as any
inferring reader does.

A quoted cell may hold line breaks, and a file with such records can't be split
between tasks. So the lines are first read as text, in as many tasks as the
files allow, and each is held against the grammar of a line that ends outside
quotes. When all lines pass, no record spans two of them, and the files are
split; otherwise each file is one task. Both readers give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER = r"^\s*[+-]?\d+\s*$"
DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
#: A line whose cells are free of quotes, or quoted as a whole without a quote, backslash or break inside: it surely
#: starts and ends outside quotes. Other lines may be as good, but are not taken for it.
WHOLE_LINE = r'^([^",]*|"[^"\\]*")(,([^",]*|"[^"\\]*"))*$'
_MALFORMED = "_malformed_record"


class MalformedRecords(ValueError):
    pass


def _is_integral_text(c):
    # whole numbers written without a fraction or exponent
    return c.rlike(INTEGER) & c.try_cast("bigint").isNotNull()


def infer_types(raw: DataFrame) -> dict[str, str]:
    return _types_and_malformed(raw)[0]


def _types_and_malformed(raw: DataFrame) -> tuple[dict[str, str], int]:
    columns = [c for c in raw.columns if c != _MALFORMED]
    aggs = [F.count(_MALFORMED).alias("malformed") if _MALFORMED in raw.columns else F.lit(0).alias("malformed")]
    for c in columns:
        v = F.col(f"`{c}`")
        aggs += [
            F.count(v).alias(f"n|{c}"),
            F.count(F.when(_is_integral_text(v), 1)).alias(f"i|{c}"),
            F.count(F.when(v.rlike(DECIMAL), 1)).alias(f"d|{c}"),
        ]
    counts = raw.agg(*aggs).first().asDict()
    types = {}
    for c in columns:
        n, i, d = counts[f"n|{c}"], counts[f"i|{c}"], counts[f"d|{c}"]
        types[c] = "bigint" if n > 0 and i == n else "double" if n > 0 and d == n else "string"
    return types, counts["malformed"]


def may_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether a record could reach over the end of a line."""
    lines = spark.read.text(path)
    return not lines.where(F.col("value").contains('"') & ~F.col("value").rlike(WHOLE_LINE)).isEmpty()


def read_csv_typed(spark: SparkSession, path: str, malformed: str | None = None,
                   multi_line: bool | None = None) -> DataFrame:
    """Records with more or fewer cells than the header are an error, or, with
    ``malformed``, kept: that column holds their text and is NULL elsewhere.
    Quoted line breaks belong to their cell. Files without any are split
    between tasks; ``multi_line`` skips the pass that finds out."""
    if multi_line is None:
        multi_line = may_span_lines(spark, path)
    reader = spark.read.option("header", True).option("inferSchema", False).option("multiLine", multi_line)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _MALFORMED]])
    raw = reader.schema(schema).option("columnNameOfCorruptRecord", _MALFORMED).option("enforceSchema", True).csv(path)
    types, broken = _types_and_malformed(raw)
    if broken and malformed is None:
        raise MalformedRecords(f"{broken} records have more or fewer cells than the header")
    kept = [F.col(_MALFORMED).alias(malformed)] if malformed else []
    return raw.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()], *kept)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
