"""Example statistics (M1), schema inference (M2) and example validation (M3).

Scale notes:
  * statistics of numbers are one wide ``groupBy(split)`` aggregate over all
    columns in a single pass (partial aggregation; the shuffle carries one row per
    split per mapper), then unpivoted on the tiny result.
  * everything about text comes from one written table of counted values
    (``counted_values``: split, column, value, freq), made in one scan for all
    columns: distinct values, lengths, top values, domains, unseen values. No
    distinct aggregate, so no Expand, however many text columns there are.
  * quantiles are exact, from counted buckets whose values are counted and
    range-sorted in a second pass (``column_quantiles``); an exact percentile
    aggregate would hold every distinct value of a column in one task.
  * histograms reuse the per-split bounds through a broadcast join on ``split``
    (one row per split: a fixed-size side) and count all buckets of all columns
    in one more wide aggregate.
  * domains have any size: unseen values are found by an anti-join of the
    counted values with the domain, both as tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featpipe.functions.frames import broadcast_if_small
from featpipe.functions.ranks import running_totals, write_once

SPLITS = ("train", "eval")
HISTOGRAM_BUCKETS = 10
MAX_STRING_DOMAIN = 100
MAX_BROADCAST_ROWS = 10000


def feature_kinds(df: DataFrame, exclude=("split",)) -> dict[str, str]:
    """'INT' / 'FLOAT' / 'BYTES' per column, as the schema types."""
    out = {}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.IntegralType):
            out[f.name] = "INT"
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = "FLOAT"
        else:
            out[f.name] = "BYTES"
    return out


def _number(v):
    x = v.cast("double")
    return F.when(~F.isnan(x), x)


def _wide_stats(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (c, kind) in enumerate(kinds.items()):
        v = F.col(f"`{c}`")
        aggs.append(F.count(v).alias(f"n{i}"))
        x = _number(v)   # NaN counts as a value but has no place in moments or bounds
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_pop(x).alias(f"s{i}"), F.count(F.when(x == 0, 1)).alias(f"z{i}")]
    return df.groupBy("split").agg(*aggs)


_STAT_FIELDS = [("count", "bigint"), ("missing", "bigint"), ("min", "double"), ("max", "double"),
                ("mean", "double"), ("std_dev", "double"), ("zeros", "bigint"), ("distinct", "bigint"),
                ("avg_length", "double")]


def counted_values(df: DataFrame, columns) -> DataFrame:
    """``(split, column, value, freq)`` of the columns' values as text, NULL
    with its own count: one scan for all columns, counted on the mappers first,
    written once."""
    return write_once(value_frequencies(df, columns), "counted-values")


def _text_stats(counted: DataFrame) -> DataFrame:
    known = F.col("value").isNotNull()
    n = F.sum(F.when(known, F.col("freq")).otherwise(0))
    letters = F.sum(F.when(known, F.length("value").cast("bigint") * F.col("freq")))
    s = counted.groupBy("split", "column").agg(
        n.alias("count"), F.sum(F.when(known, 0).otherwise(F.col("freq"))).alias("missing"),
        F.count(F.when(known, 1)).alias("distinct"), (letters.cast("double") / F.nullif(n, F.lit(0))).alias("avg_length"))
    vals = {c: F.col(c) for c in ("count", "missing", "distinct", "avg_length")}
    return s.select("split", "column", F.lit("BYTES").alias("type"),
                    *[vals.get(k, F.lit(None)).cast(t).alias(k) for k, t in _STAT_FIELDS])


def column_stats(df: DataFrame, kinds: dict[str, str] | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Long-form statistics ``(split, column, type, count, missing, min, max,
    mean, std_dev, zeros, distinct, avg_length)``; numeric fields are NULL for
    text columns and the reverse. ``counted`` (``counted_values`` of the text
    columns at least) is made here when not given."""
    kinds = kinds or feature_kinds(df)
    text = [c for c, k in kinds.items() if k == "BYTES"]
    numbers = {c: k for c, k in kinds.items() if k != "BYTES"}
    out = None
    if text:
        counted = counted_values(df, text) if counted is None else counted
        out = _text_stats(counted.where(F.col("column").isin(text)))
    if not numbers and out is not None:
        return out
    w = _wide_stats(df, numbers)
    nul = {t: F.lit(None).cast(t) for _, t in _STAT_FIELDS}
    structs = []
    for i, (c, kind) in enumerate(numbers.items()):
        n = F.col(f"n{i}")
        vals = {"count": n, "missing": F.col("_rows") - n, "min": F.col(f"mn{i}"), "max": F.col(f"mx{i}"),
                "mean": F.col(f"a{i}"), "std_dev": F.col(f"s{i}"), "zeros": F.col(f"z{i}")}
        structs.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"),
                                *[vals.get(k, nul[t]).cast(t).alias(k) for k, t in _STAT_FIELDS]))
    rows = w.select("split", F.explode(F.array(*structs)).alias("_s")).select("split", "_s.*")
    return rows if out is None else rows.unionByName(out)


QUANTILE_BUCKETS = 1024


def column_quantiles(df: DataFrame, kinds: dict[str, str] | None = None,
                     probs=(0.25, 0.5, 0.75), buckets: int = QUANTILE_BUCKETS) -> DataFrame:
    """Exact quantiles per split and numeric column: the smallest value with at
    least ``p`` of the non-missing values at or below it (NaN left out).

    Pass one counts ``buckets`` equal-width buckets and finds, from their
    running counts, the one each quantile lies in. Pass two counts the values
    of these buckets alone, range-sorts them and adds up prefix sums, so a
    bucket that holds a whole column (one far outlier is enough) is spread over
    the tasks like any other. Both passes count on the mappers first."""
    kinds = kinds or feature_kinds(df)
    num = [c for c, k in kinds.items() if k != "BYTES"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _number(F.col(f"`{c}`")).alias("value")) for c in num])
    values = df.select("split", F.explode(cells).alias("_c")).select("split", "_c.*").where("value is not null")
    bounds = values.groupBy("split", "column").agg(F.min("value").alias("_low"), F.max("value").alias("_high"),
                                                   F.count(F.lit(1)).alias("_n"))
    bounds = broadcast_if_small(bounds, MAX_BROADCAST_ROWS)
    place = F.when(F.col("_high") == F.col("_low"), F.lit(0)).otherwise(F.least(
        F.floor((F.col("value") - F.col("_low")) / (F.col("_high") - F.col("_low")) * float(buckets)), F.lit(buckets - 1)))
    placed = values.join(bounds, ["split", "column"]).select("split", "column", "value", "_n", place.cast("int").alias("_bucket"))
    running = Window.partitionBy("split", "column").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counted = (placed.groupBy("split", "column", "_bucket").agg(F.count(F.lit(1)).alias("_count"), F.first("_n").alias("_n"))
               .withColumn("_upto", F.sum("_count").over(running)))
    asked = F.array(*[F.struct(F.lit(j).alias("_j"), F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1)).alias("_rank"))
                      for j, p in enumerate(probs)])
    hit = (counted.withColumn("_q", F.explode(asked))
           .where((F.col("_q._rank") <= F.col("_upto")) & (F.col("_q._rank") > F.col("_upto") - F.col("_count")))
           .select("split", "column", "_bucket", "_q._j", (F.col("_q._rank") - F.col("_upto") + F.col("_count")).alias("_rank")))
    hit = broadcast_if_small(hit, MAX_BROADCAST_ROWS)
    inside = (placed.join(hit, ["split", "column", "_bucket"]).groupBy("split", "column", "_j", "value")
              .agg(F.count(F.lit(1)).alias("_count"), F.first("_rank").alias("_rank")))
    found = (running_totals(inside, ["split", "column", "_j"], ["value"], "_count", "quantile-values", "_upto")
             .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_count") < F.col("_rank"))))
    return found.groupBy("split", "column").agg(
        *[F.min(F.when(F.col("_j") == j, F.col("value"))).alias(f"p{int(p * 100)}") for j, p in enumerate(probs)])


def column_histogram(df: DataFrame, kinds: dict[str, str] | None = None,
                     buckets: int = HISTOGRAM_BUCKETS, stats: DataFrame | None = None) -> DataFrame:
    """Equal-width histogram per split and numeric column:
    ``(split, column, bucket, low, high, count)``; bucket ``b`` covers
    ``[min + b*w, min + (b+1)*w)``, the last one closed; a constant column has
    everything in bucket 0. With ``stats`` (``column_stats`` output) the
    bounds come from there, and the histogram is a single pass."""
    kinds = kinds or feature_kinds(df)
    num = [c for c, k in kinds.items() if k != "BYTES"]
    if stats is not None:
        s = stats.where(F.col("column").isin(num))
        bounds = s.groupBy("split").agg(
            *[F.max(F.when(F.col("column") == c, F.col("min"))).alias(f"mn{i}") for i, c in enumerate(num)],
            *[F.max(F.when(F.col("column") == c, F.col("max"))).alias(f"mx{i}") for i, c in enumerate(num)])
    else:
        bounds = df.groupBy("split").agg(
            *[F.min(_number(F.col(f"`{c}`"))).alias(f"mn{i}") for i, c in enumerate(num)],
            *[F.max(_number(F.col(f"`{c}`"))).alias(f"mx{i}") for i, c in enumerate(num)])
    # one row per split value: broadcast after a size check
    j = df.join(broadcast_if_small(bounds, MAX_BROADCAST_ROWS), "split")
    cols = []
    for i, c in enumerate(num):
        x, mn, mx = _number(F.col(f"`{c}`")), F.col(f"mn{i}"), F.col(f"mx{i}")
        # least() skips NULLs: without the first case a missing value would fall into the last bucket
        b = F.when(x.isNull(), F.lit(None)).when(mx == mn, F.lit(0)).otherwise(
            F.least(F.floor((x - mn) / (mx - mn) * float(buckets)), F.lit(buckets - 1)))
        cols.append(b.alias(f"b{i}"))
    jb = j.select("split", *[f"mn{i}" for i in range(len(num))], *[f"mx{i}" for i in range(len(num))], *cols)
    counts = jb.groupBy("split", *[f"mn{i}" for i in range(len(num))], *[f"mx{i}" for i in range(len(num))]).agg(
        *[F.count(F.when(F.col(f"b{i}") == k, 1)).alias(f"c{i}_{k}") for i in range(len(num)) for k in range(buckets)])
    structs = []
    for i, c in enumerate(num):
        mn, mx = F.col(f"mn{i}"), F.col(f"mx{i}")
        width = (mx - mn) / float(buckets)
        for k in range(buckets):
            structs.append(F.struct(F.lit(c).alias("column"), F.lit(k).alias("bucket"),
                                    (mn + width * k).alias("low"),
                                    F.when(F.lit(k) == buckets - 1, mx).otherwise(mn + width * (k + 1)).alias("high"),
                                    F.col(f"c{i}_{k}").alias("count")))
    return counts.select("split", F.explode(F.array(*structs)).alias("_s")).select("split", "_s.*")


def value_frequencies(df: DataFrame, columns) -> DataFrame:
    """``(split, column, value, freq)`` for categorical columns, values as
    text: one scan and one aggregate for all of them."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return (df.select("split", F.explode(cells).alias("_c")).groupBy("split", "_c.column", "_c.value")
            .agg(F.count(F.lit(1)).alias("freq")))


def column_topk(df: DataFrame, columns, k: int = 10, splits=SPLITS, counted: DataFrame | None = None) -> DataFrame:
    """Top ``k`` values per split and column by frequency (ties: smaller text
    first), with their rank; missing values are not counted. Every task keeps
    ``k`` values of a group before they are dealt out."""
    freqs = (value_frequencies(df, columns) if counted is None else counted).where(
        F.col("value").isNotNull() & F.col("split").isin(list(splits)) & F.col("column").isin(list(columns)))
    w = Window.partitionBy("split", "column").orderBy(F.desc("freq"), F.asc("value"))
    return freqs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ------------------------------------------------------------------ schema

def infer_schema(stats: DataFrame, freqs: DataFrame | None = None, train_split: str = "train",
                 max_domain: int | None = MAX_STRING_DOMAIN):
    """M2: constraints from the training split's statistics:
    ``(column, type, required, min_fraction, domain_size)`` and, for text
    columns with at most ``max_domain`` distinct values (None: with any number),
    the domain ``(column, value)``. Shapes are not inferred."""
    t = stats.where(F.col("split") == train_split)
    required = F.col("missing") == 0
    constraints = t.select(
        "column", "type", required.alias("required"),
        F.when(required, 1.0).otherwise(0.0).alias("min_fraction"),
        F.when((F.col("type") == "BYTES") & (F.lit(True) if max_domain is None else F.col("distinct") <= max_domain),
               F.col("distinct")).alias("domain_size"),
    )
    domain = None
    if freqs is not None:
        # one constraint row per column: the names of domain columns are a
        # short list, used as a filter (a join on a constant-valued column
        # would be planned as a nested loop)
        dcols = [r["column"] for r in constraints.where(F.col("domain_size").isNotNull())
                 .select("column").collect()]
        domain = (freqs.where((F.col("split") == train_split) & F.col("value").isNotNull()
                              & F.col("column").isin(dcols))
                  .select("column", "value").distinct())
    return constraints, domain


_SCHEMA_TYPES = {"INT": T.LongType(), "FLOAT": T.DoubleType(), "BYTES": T.StringType()}


def schema_struct(constraints: DataFrame) -> T.StructType:
    """M2 as a Spark schema: one field per constraint row (one row per
    column, so collecting it is bounded by the column count); a required
    column is not nullable."""
    rows = sorted(constraints.select("column", "type", "required").collect(), key=lambda r: r["column"])
    return T.StructType([T.StructField(r["column"], _SCHEMA_TYPES[r["type"]], not r["required"]) for r in rows])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` decoded by an inferred schema: its columns in the schema's types
    (a value that is none becomes NULL, as does a column that is gone), the
    others after them as they are. What does not fit is the validation report's to tell."""
    names = {f.name for f in schema.fields}
    typed = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
             for f in schema.fields]
    return df.select(*typed, *[F.col(f"`{c}`") for c in df.columns if c not in names])


def validate_examples(df: DataFrame, stats: DataFrame, constraints: DataFrame,
                      domain: DataFrame | None, splits=SPLITS, counted: DataFrame | None = None) -> DataFrame:
    """M3: one report row per (split, column, check):
    ``(split, column, check, n_bad, ok)`` with checks ``presence``, ``type``,
    ``domain``, ``missing_column`` and ``unknown_column``. A text column whose
    domain was not inferred has a ``domain`` row with null ``n_bad`` and ``ok``.
    Unseen values are counted by an anti-join of ``counted`` (``counted_values``
    of ``df``, made here when not given) with the domain, of any size.
    Advisory: nothing is raised; ``anomalies(report)`` keeps the failed rows."""
    parts = []
    for s in splits:
        st = stats.where(F.col("split") == s).select(
            "column", F.col("type").alias("_dtype"), "count", "missing")
        j = st.join(constraints, "column", "full_outer")
        present = F.col("_dtype").isNotNull()
        known = F.col("type").isNotNull()
        frac = F.col("count") / (F.col("count") + F.col("missing"))
        rows = [
            F.struct(F.lit("presence").alias("check"),
                     F.when(frac < F.col("min_fraction"), F.col("missing")).otherwise(F.lit(0)).cast("bigint").alias("n_bad"),
                     (frac >= F.col("min_fraction")).alias("ok"), (present & known).alias("_emit")),
            F.struct(F.lit("type").alias("check"),
                     F.when(F.col("_dtype") != F.col("type"), F.col("count")).otherwise(F.lit(0)).cast("bigint").alias("n_bad"),
                     (F.col("_dtype") == F.col("type")).alias("ok"), (present & known).alias("_emit")),
            F.struct(F.lit("missing_column").alias("check"), F.lit(0).cast("bigint").alias("n_bad"),
                     F.lit(False).alias("ok"), (~present & known).alias("_emit")),
            F.struct(F.lit("unknown_column").alias("check"), F.col("count").cast("bigint").alias("n_bad"),
                     F.lit(False).alias("ok"), (present & ~known).alias("_emit")),
        ]
        if domain is not None:
            # a text column whose domain was not inferred: its values are unchecked, neither good nor bad
            rows.append(F.struct(F.lit("domain").alias("check"), F.lit(None).cast("bigint").alias("n_bad"),
                                 F.lit(None).cast("boolean").alias("ok"),
                                 (present & known & (F.col("type") == "BYTES") & F.col("domain_size").isNull()).alias("_emit")))
        parts.append(j.select(F.lit(s).alias("split"), "column", F.explode(F.array(*rows)).alias("_r"))
                     .where("_r._emit").select("split", "column", "_r.check", "_r.n_bad", "_r.ok"))
    if domain is not None:
        dcols = [r["column"] for r in constraints.where(F.col("domain_size").isNotNull())
                 .select("column").collect() if r["column"] in df.columns]
        if dcols:
            if counted is None:
                counted = counted_values(df.where(F.col("split").isin(list(splits))), dcols)
            bad = (counted.where(F.col("value").isNotNull() & F.col("column").isin(dcols))
                   .join(domain, ["column", "value"], "left_anti")
                   .groupBy("split", "column").agg(F.sum("freq").alias("_bad")))
            # a split without unseen values reports 0
            every = df.sparkSession.createDataFrame([(s, c) for s in splits for c in dcols], "split string, column string")
            n_bad = F.coalesce(F.col("_bad"), F.lit(0)).cast("bigint")
            parts.append(every.join(bad, ["split", "column"], "left").select(
                "split", "column", F.lit("domain").alias("check"), n_bad.alias("n_bad"), (n_bad == 0).alias("ok")))
    return reduce(DataFrame.unionByName, parts)


def anomalies(report: DataFrame) -> DataFrame:
    return report.where(~F.col("ok"))


class ValidationError(ValueError):
    pass


def require_valid(report: DataFrame, max_shown: int = 20) -> DataFrame:
    """Strict mode: raise when the report has an anomaly (validation itself is
    advisory and never stops a pipeline). Only up to ``max_shown`` failed rows
    are brought to the driver for the message."""
    bad = anomalies(report).take(max_shown)
    if bad:
        detail = ", ".join(f"{r['split']}/{r['column']}/{r['check']}={r['n_bad']}" for r in bad)
        raise ValidationError(f"example validation failed: {detail}")
    return report
