"""Evaluation (M14), quality gate (M15), gated publishing (M16) and the
latest-artifact lookup (M17)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The gated metric and its inclusive bounds; MSE is reported only.
MAE, MSE = "mean_absolute_error", "mean_squared_error"
DEFAULT_THRESHOLDS = [(MAE, 1.0, 4.0)]

MANIFEST_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("update_time", T.TimestampType()),
    T.StructField("blessed", T.BooleanType()),
    T.StructField("published", T.BooleanType()),
    T.StructField("path", T.StringType()),
    T.StructField("mean_absolute_error", T.DoubleType()),
])


def _metric_aggs(label: str, prediction: str):
    err = F.col(prediction) - F.col(label)
    return [F.avg(F.abs(err)).alias(MAE), F.avg(err * err).alias(MSE), F.count(F.col(label)).alias("n"),
            F.count(F.when(F.col(label).isNull(), 1)).alias("n_missing_label")]


def eval_metrics(df: DataFrame, label: str, prediction: str = "prediction", slices=()) -> DataFrame:
    """MAE and MSE over the overall slice (or per ``slices`` columns).
    Rows with a NULL label are skipped by the averages and counted apart."""
    g = df.groupBy(*slices) if slices else df.groupBy()
    return g.agg(*_metric_aggs(label, prediction))


def eval_metrics_sliced(df: DataFrame, label: str, slices, prediction: str = "prediction") -> DataFrame:
    """M14 over a list of slices in one pass: each slice is a tuple of columns,
    the empty one is the overall slice. ``(slice, value, ...)``: the columns'
    names and their values as text, joined by ``,``; a NULL value is ``NULL``."""
    slices = [tuple(s) for s in slices]
    columns = list(dict.fromkeys(c for s in slices for c in s))
    if not columns:
        m = eval_metrics(df, label, prediction)
        return m.select(F.lit("").alias("slice"), F.lit("").alias("value"), *m.columns)
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(f"_{c}") for c in columns],
                      F.col(label), F.col(prediction))
    sets = [[F.col(f"_{c}") for c in s] for s in slices]
    grouped = named.groupingSets(sets, *[f"_{c}" for c in columns]).agg(
        F.grouping_id().alias("_id"), *_metric_aggs(label, prediction))
    # a column left out of a set has its bit set, the first column's highest
    left_out = {s: sum(1 << (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in s) for s in slices}
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for s, bits in left_out.items():
        name = F.when(F.col("_id") == bits, F.lit(",".join(s))).otherwise(name)
        value = F.when(F.col("_id") == bits, F.concat_ws(",", *[F.col(f"_{c}") for c in s])).otherwise(value)
    return grouped.select(name.alias("slice"), value.alias("value"), MAE, MSE, "n", "n_missing_label")


def metrics_long(metrics: DataFrame) -> DataFrame:
    return metrics.select(F.explode(F.array(
        F.struct(F.lit(MAE).alias("metric"), F.col(MAE).alias("value")),
        F.struct(F.lit(MSE).alias("metric"), F.col(MSE).alias("value")),
    )).alias("_m")).select("_m.*")


def quality_gate(metrics: DataFrame, thresholds=DEFAULT_THRESHOLDS) -> DataFrame:
    """``(metric, value, lower_bound, upper_bound, ok, blessed)``. Bounds
    are inclusive; a metric without a threshold is reported and always ok;
    ``blessed`` is true when every gated metric is within its bounds (a metric
    with no value fails)."""
    spark = metrics.sparkSession
    th = spark.createDataFrame(thresholds, "metric string, lower_bound double, upper_bound double")
    j = metrics_long(metrics).join(F.broadcast(th), "metric", "left")
    gated = F.col("lower_bound").isNotNull() | F.col("upper_bound").isNotNull()
    within = (F.coalesce(F.col("value") >= F.col("lower_bound"), F.lit(True))
              & F.coalesce(F.col("value") <= F.col("upper_bound"), F.lit(True)))
    ok = F.when(~gated, F.lit(True)).otherwise(F.col("value").isNotNull() & within)
    rows = j.select("metric", "value", "lower_bound", "upper_bound", ok.alias("ok"))
    every = Window.partitionBy(F.lit(0))   # a row per metric; the metrics are planned once
    return rows.withColumn("blessed", F.count(F.when(~F.col("ok"), 1)).over(every) == 0)


def is_blessed(gate: DataFrame) -> bool:
    return bool(gate.select(F.min(F.col("blessed").cast("int"))).first()[0])


#: An empty file that is written last: a version without it is a failed attempt.
COMMITTED = "_COMMITTED"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_committed(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, f"{path}/{COMMITTED}")
    return fs.exists(p)


def gated_publish(spark: SparkSession, gate: DataFrame, registry: str, name: str, save_fn,
                  version: str | None = None) -> DataFrame:
    """When blessed, ``save_fn(path)`` stores the model and parameters
    under the registry; a manifest row is added either way (``published``
    false when not blessed). Returns this run's row.

    ``save_fn`` writes to a staging folder, which is renamed to the version's
    folder and marked as committed before the manifest row is written, so an
    attempt that fails leaves neither half a model nor a row. The row is a file
    of its own named by the version: publishing one ``version`` again, after a
    failure or twice, finds what is committed and writes the same single row."""
    rows = [(r["metric"], r["value"], r["blessed"]) for r in gate.select("metric", "value", "blessed").collect()]
    blessed = all(bool(b) for *_, b in rows) and bool(rows)
    version = version or uuid.uuid4().hex
    registry = registry.rstrip("/")
    path = f"{registry}/{name}/{version}"
    if blessed and not is_committed(spark, path):
        staging = f"{registry}/_staging/{name}-{version}-{uuid.uuid4().hex}"
        save_fn(staging)
        fs, to = _path(spark, path)
        if fs.exists(to):   # an earlier attempt came as far as the rename
            fs.delete(to, True)
        made = _path(spark, staging)[1]
        fs.mkdirs(to.getParent() if fs.exists(made) else to)   # a save_fn may write nothing
        if fs.exists(made) and not fs.rename(made, to):
            raise OSError(f"{staging} could not be renamed to {path}")
        fs.create(_path(spark, f"{path}/{COMMITTED}")[1], True).close()
    manifest = f"{registry}/_manifest"
    fs, own = _path(spark, f"{manifest}/version={version}/_SUCCESS")
    if not fs.exists(own):
        mae = next((v for m, v, _ in rows if m == MAE), None)
        row = spark.createDataFrame([(name, None, blessed, blessed, path if blessed else None, mae)],
                                    T.StructType([f for f in MANIFEST_SCHEMA if f.name != "version"]))
        row.withColumn("update_time", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{manifest}/version={version}")
    return read_manifest(spark, registry).where(F.col("version") == version)


def read_manifest(spark: SparkSession, registry: str) -> DataFrame:
    """All manifest rows of a registry."""
    return (spark.read.schema(MANIFEST_SCHEMA).parquet(f"{registry.rstrip('/')}/_manifest")
            .select(*[f.name for f in MANIFEST_SCHEMA]))


def latest_artifact(manifest: DataFrame, name: str = "name", time: str = "update_time",
                    tiebreak: str = "version") -> DataFrame:
    """Newest row per ``name`` by ``time`` (ties: larger ``tiebreak``).
    ``max_by`` is a partial aggregate: a name with many versions is reduced on
    every mapper first."""
    others = [c for c in manifest.columns if c != name]
    latest = manifest.groupBy(name).agg(
        F.max_by(F.struct(*others), F.struct(F.col(time), F.col(tiebreak))).alias("_r"))
    return latest.select(name, "_r.*")
