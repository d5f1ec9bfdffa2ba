"""The tabular pipeline end to end (the source's component chain):

  ingest -> split -> statistics -> schema -> validation -> fit/apply transform
  -> write transformed examples -> fit regression -> evaluate on raw eval rows
  -> gate -> publish when blessed.

Each stage is a DataFrame function; the only materialisation is the written
transformed examples (so iterative fitting does not recompute the transform)
plus the published artifacts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from featpipe.functions.frames import bounded_local
from featpipe.operators import evaluate, features, model, profile
from featpipe.session import scratch_path
from featpipe.sources import examples as ex


@dataclass
class PipelineResult:
    stats: DataFrame
    histogram: DataFrame
    constraints: DataFrame
    report: DataFrame
    params: features.FittedParams
    model: object
    metrics: DataFrame
    gate: DataFrame
    manifest_row: DataFrame
    examples: DataFrame
    transformed: DataFrame


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_pipeline(spark: SparkSession, raw: DataFrame, registry: str | None = None,
                 spec: features.FeatureSpec = features.FeatureSpec(), algorithm: str = "linear",
                 name: str = "trips-regressor", thresholds=evaluate.DEFAULT_THRESHOLDS,
                 preprocess=None, estimator=None,
                 max_domain: int | None = profile.MAX_STRING_DOMAIN) -> PipelineResult:
    """``preprocess`` (DataFrame -> DataFrame) runs on the raw rows before the
    split; ``estimator`` replaces the regression of ``algorithm``;
    ``max_domain`` bounds the domains that are inferred. Histogram and report
    are written, and read from there by the result."""
    if preprocess is not None:
        raw = preprocess(raw)
    # example generation: the split examples are written once (partitioned by
    # split) and every later stage reads them, as the source's components do
    examples = ex.read_examples(spark, ex.write_examples(ex.hash_split(raw), scratch_path(spark, "examples")))
    kinds = profile.feature_kinds(examples)
    text_cols = [c for c, k in kinds.items() if k == "BYTES"]
    counted = profile.counted_values(examples, text_cols) if text_cols else None
    # one row per (split, column): computed once, reused by schema and checks
    stats = bounded_local(profile.column_stats(examples, kinds, counted), 10_000)
    # bounds from the statistics above: the histogram is one more pass (lazy)
    histogram = _written(profile.column_histogram(examples, kinds, stats=stats), "histogram")
    constraints, domain = profile.infer_schema(stats, counted, max_domain=max_domain)
    report = _written(profile.validate_examples(examples, stats, constraints, domain, counted=counted), "report")

    # the transform, and everything after it, decodes the examples by the inferred schema
    examples = profile.conform(examples, profile.schema_struct(constraints))
    params = features.fit(examples.where("split = 'train'"), spec)
    # transformed examples are stored compactly: one-hot positions, not
    # dense vectors; the model expands them sparsely
    path = ex.write_examples(features.apply(examples, params, onehot="index"), scratch_path(spark, "transformed"))
    train = ex.read_examples(spark, path, "train")
    fitted = model.regress_fit(train, spec, algorithm, estimator=estimator)

    # evaluation runs on raw eval rows: NULL labels are skipped, not filled
    scored = score_with_raw_label(examples.where("split = 'eval'"), params, fitted, spec)
    # one row, computed once: gate, manifest and result all read it
    metrics = bounded_local(evaluate.eval_metrics(scored, "_raw_label"), 1)
    gate = evaluate.quality_gate(metrics, thresholds)

    def _save(p):
        features.save_params(params, f"{p}/transform")
        model.save_model(fitted, f"{p}/model")

    manifest_row = evaluate.gated_publish(spark, gate, registry or scratch_path(spark, "registry"), name, _save)
    return PipelineResult(stats, histogram, constraints, report, params, fitted, metrics, gate, manifest_row,
                          examples, ex.read_examples(spark, path))


def score_with_raw_label(eval_raw: DataFrame, params, fitted, spec) -> DataFrame:
    """Score eval rows keeping their raw (unfilled) label next to the
    prediction: the label column is carried through ``apply`` under another
    name, so no join is needed."""
    from pyspark.sql import functions as F
    rows = eval_raw.withColumn("_raw_label", F.col(spec.label)).drop(spec.label)
    return model.score(fitted, rows, params, keep=("_raw_label",))
