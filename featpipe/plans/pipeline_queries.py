"""Registered queries of the tabular pipeline over ``trips`` (derived from the
driver's ``lineitem`` and ``orders``), with DuckDB oracles where SQL can
express the result.

One-hot vectors are reported in a compact exact form per row: depth (length),
hot position (of the 1.0) and number of non-zero elements, which together fix
the vector. An assembled feature vector is reported as its length, the hot
position inside each one-hot segment, the non-zero count of those segments and
every numeric element read at its position. All of it is lambda-free column
arithmetic. Floating results whose summation order may differ between engines
go through ``fixed`` on both sides.

Queries without an oracle (model fits, predictions, the whole chain) return what
the model or the run gives, row by row; tests hold them against plain computations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featpipe.functions.frames import bounded_local
from featpipe.functions.keys import epoch_seconds
from featpipe.functions.numeric import fixed, fixed_sql
from featpipe.operators import evaluate, features, model, profile
from featpipe.plans.inputs import derived_once, trip_examples
from featpipe.session import scratch_path
from featpipe.sources import csv as csv_src
from featpipe.sources import examples as ex
from featpipe.sources.tables import read_table
from featpipe.sources.trips import (CATEGORICAL_FEATURE_KEYS, LABEL_KEY, NUMERIC_FEATURE_KEYS, TRIP_COLUMNS,
                                    TRIPS_SQL, trips)

SPEC = features.FeatureSpec()
# comparison places: about 1e-9 of the magnitude (MAE ~ 1e4, MSE ~ 1e9 here),
# well above the last-bit noise of summing in another order
MAE_PLACES, MSE_PLACES = 3, 0
XF = features.transformed_name
TOPK_VALUES = 10


# ---------------------------------------------------------------- shared

def _examples(spark, d):
    return trip_examples(spark, d)


def _train(spark, d):
    return _examples(spark, d).where(F.col("split") == "train")


def _fit(spark, d):
    return features.fit(_train(spark, d), SPEC)


def _nonzeros(arr):
    return F.size(F.array_remove(arr, F.lit(0.0))).cast("bigint")


def _compact_onehot(df, feature):
    arr = F.col(XF(feature))
    return [F.size(arr).cast("bigint").alias(f"{XF(feature)}_depth"),
            (F.array_position(arr, F.lit(1.0)) - 1).cast("bigint").alias(f"{XF(feature)}_hot"),
            _nonzeros(arr).alias(f"{XF(feature)}_nnz")]


def _compact(df, keep=("split",)):
    cols = [F.col(k) for k in keep if k in df.columns]
    cols += [fixed(XF(c), 6).alias(XF(c)) for c in SPEC.numeric]
    for c in SPEC.categorical:
        cols += _compact_onehot(df, c)
    if LABEL_KEY in df.columns:
        cols.append(F.col(LABEL_KEY))
    return df.select(*cols)


def _transformed(spark, d):
    return features.apply(_examples(spark, d), _fit(spark, d))


# ---------------------------------------------------------------- S2-S5

def q_csv_ingest(spark, d):
    path = csv_src.write_csv(trips(spark, d), scratch_path(spark, "trips-csv"))
    return csv_src.read_csv_typed(spark, path)


def q_hash_split(spark, d):
    return ex.hash_split(trips(spark, d))


def q_transformed_roundtrip(spark, d):
    path = ex.write_examples(_transformed(spark, d), scratch_path(spark, "transformed"))
    return _compact(ex.read_examples(spark, path, "eval"))


def q_transformed_roundtrip_all(spark, d):
    """Every split of the written examples."""
    path = ex.write_examples(_transformed(spark, d), scratch_path(spark, "transformed"))
    return _compact(ex.read_examples(spark, path))


def _save_artifact(params, fitted, path):
    features.save_params(params, f"{path}/transform")
    model.save_model(fitted, f"{path}/model")
    return path


def _artifact(spark, d):
    """(params, model) of the regression as saved, fitted once per session."""
    def build():
        params, fitted, _ = _fitted_model(spark, d)
        return _save_artifact(params, fitted, scratch_path(spark, "artifact"))
    path = derived_once(spark, "artifact", d, build, read=lambda p: features.load_params(spark, f"{p}/transform"))
    return features.load_params(spark, f"{path}/transform"), model.load_model(f"{path}/model")


def _raw_rows(e):
    """Raw examples without their label, which scoring must not need."""
    return e.drop(LABEL_KEY)


def q_artifact_roundtrip(spark, d):
    """Predictions of a model and transform that were fitted, saved and loaded back."""
    params, fitted, _ = _fitted_model(spark, d)
    path = _save_artifact(params, fitted, scratch_path(spark, "artifact"))
    raw = _raw_rows(_examples(spark, d))
    return model.score(model.load_model(f"{path}/model"), raw, features.load_params(spark, f"{path}/transform"), keep=tuple(raw.columns))


# ---------------------------------------------------------------- M1-M3

def _stats(spark, d):
    return profile.column_stats(_examples(spark, d))


# Nullable counts are reported as double in the registered queries and their
# oracles: one representation in every client (nullable integers become
# floats in some dataframe conversions and stay integers in others).
NULLABLE_COUNTS = ("zeros", "distinct", "domain_size")


def q_column_stats(spark, d):
    s = _stats(spark, d)
    return s.select(*[fixed(c, 4).alias(c) if c in ("mean", "std_dev")
                      else fixed(c, 6).alias(c) if c == "avg_length"
                      else F.col(c).cast("double").alias(c) if c in NULLABLE_COUNTS else F.col(c)
                      for c in s.columns])


def q_column_quantiles(spark, d):
    return profile.column_quantiles(_examples(spark, d))


def q_column_histogram(spark, d):
    return profile.column_histogram(_examples(spark, d))


def q_column_topk(spark, d):
    return profile.column_topk(_examples(spark, d), CATEGORICAL_FEATURE_KEYS, TOPK_VALUES)


def _schema(e, max_domain=profile.MAX_STRING_DOMAIN):
    """Counted values, statistics and schema of examples, each made once."""
    kinds = profile.feature_kinds(e)
    counted = profile.counted_values(e, [c for c, k in kinds.items() if k == "BYTES"])
    stats = bounded_local(profile.column_stats(e, kinds, counted), 4 * len(kinds))   # a row per (split, column)
    return counted, stats, profile.infer_schema(stats, counted, max_domain=max_domain)


def q_infer_schema(spark, d):
    c = _schema(_examples(spark, d))[2][0]
    return c.withColumn("domain_size", F.col("domain_size").cast("double"))


def q_validate_examples(spark, d):
    e = _examples(spark, d)
    counted, stats, (constraints, domain) = _schema(e)
    return profile.validate_examples(e, stats, constraints, domain, counted=counted)


DRIFT_MONTH = 1   # eval rows of this month lose their pickup_longitude


def q_validate_drifted(spark, d):
    """The schema of the clean rows against drifted ones: a column gone, one
    added, one retyped, unseen values and missing ones in the eval split. The
    domains have any size: ``zone`` takes tens of thousands of values."""
    zone = F.concat(F.lit("z"), F.floor("pickup_longitude").cast("string"))
    e = _examples(spark, d).withColumn("zone", zone)
    _, _, (constraints, domain) = _schema(e, None)
    eval_row = F.col("split") == "eval"
    drifted = (e.drop("pickup_latitude").withColumn("extra", F.lit(1))
               .withColumn("euclidean", F.col("euclidean").cast("string"))
               .withColumn("day", F.when(eval_row, F.concat(F.lit("x"), "day")).otherwise(F.col("day")))
               .withColumn("zone", F.when(eval_row & (F.col("month") == DRIFT_MONTH), F.concat("zone", F.lit("x"))).otherwise(F.col("zone")))
               .withColumn("pickup_longitude", F.when(~eval_row | (F.col("month") != DRIFT_MONTH), F.col("pickup_longitude"))))
    return profile.validate_examples(drifted, profile.column_stats(drifted), constraints, domain)


# ---------------------------------------------------------------- M4-M11

def q_fill_missing(spark, d):
    return features.fill_missing(_examples(spark, d))


def q_zscore(spark, d):
    e = _examples(spark, d)
    filled = features.fill_missing(e)
    mom = features.fit_zscore(filled.where(F.col("split") == "train"), SPEC.numeric)
    return filled.select("split", *[fixed(features.zscore(c, *mom[c]), 6).alias(XF(c)) for c in SPEC.numeric])


def q_vocab_fit(spark, d):
    return _fit(spark, d).vocab


def q_vocab_apply(spark, d):
    params = _fit(spark, d)
    df = features.fill_missing(_examples(spark, d))
    for c in SPEC.categorical:
        df = features.apply_vocabulary(df, c, params, f"{XF(c)}_idx")
    return df.select("split", *[features.token(c).alias(f"{c}_token") for c in SPEC.categorical],
                     *[f"{XF(c)}_idx" for c in SPEC.categorical])


def q_one_hot(spark, d):
    t = _transformed(spark, d)
    return t.select("split", *[x for c in SPEC.categorical for x in _compact_onehot(t, c)])


def q_preprocess(spark, d):
    return _compact(_transformed(spark, d))


def q_assemble_features(spark, d):
    params = _fit(spark, d)
    t = features.assemble_features(features.apply(_examples(spark, d), params), SPEC, "features")
    v = F.col("features")
    # element positions (1-based) from the sorted feature order
    pos, cols, at = 1, [], {}
    for name in features.feature_order(SPEC):
        src = name[: -len(features.SUFFIX)]
        width = params.depth(src) if src in SPEC.categorical else 1
        at[name] = (pos, width)
        pos += width
    for name, (p, w) in at.items():
        src = name[: -len(features.SUFFIX)]
        if src in SPEC.categorical:
            seg = F.slice(v, p, w)
            cols += [(F.array_position(seg, F.lit(1.0)) - 1).cast("bigint").alias(f"{name}_hot"),
                     _nonzeros(seg).alias(f"{name}_nnz")]
        else:
            cols.append(fixed(F.element_at(v, p), 6).alias(name))
    return t.select("split", F.size(v).cast("bigint").alias("n_features"), *cols, LABEL_KEY)


def q_fit_apply_splits(spark, d):
    params = _fit(spark, d)
    t = features.apply(_examples(spark, d), params, with_index=True)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [fixed(F.avg(XF(c)), 6).alias(f"mean_{XF(c)}") for c in SPEC.numeric]
    aggs += [F.count(F.when(F.col(f"{XF(c)}_idx") >= params.vocab_sizes[c], 1)).alias(f"oov_{c}")
             for c in SPEC.categorical]
    return t.groupBy("split").agg(*aggs)


def q_transform_saved(spark, d):
    path = features.save_params(_fit(spark, d), scratch_path(spark, "transform"))
    params = features.load_params(spark, path)
    return _compact(features.apply(_examples(spark, d), params))


# ---------------------------------------------------------------- M12-M18

def _fitted_model(spark, d):
    """Fit on the written, compact transformed examples (one-hot positions;
    the model expands them sparsely)."""
    params = _fit(spark, d)
    path = ex.write_examples(features.apply(_examples(spark, d), params, onehot="index"),
                             scratch_path(spark, "transformed"))
    return params, model.regress_fit(ex.read_examples(spark, path, "train"), SPEC), path


def q_regress_fit(spark, d):
    """Per split: rows, errors of the fitted regression and of the training mean, and the share of variance explained."""
    params, fitted, path = _fitted_model(spark, d)
    pred = model.predict(fitted, ex.read_examples(spark, path), SPEC)
    label = F.col(LABEL_KEY)
    mean = ex.read_examples(spark, path, "train").select(F.avg(label)).scalar()
    error, plain = F.col("prediction") - label, mean - label
    return pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"),
        F.avg(F.abs(plain)).alias("mae_of_mean"), F.avg(plain * plain).alias("mse_of_mean"),
        (1 - F.avg(error * error) / F.var_pop(label)).alias("r2"))


def q_score_batch(spark, d):
    """Predictions for all raw rows, label absent: the rows and what the saved model makes of them."""
    params, fitted = _artifact(spark, d)
    raw = _raw_rows(_examples(spark, d))
    return model.score(fitted, raw, params, keep=tuple(raw.columns))


def q_score_stream(spark, d):
    """The same predictions from a stream over the examples' files."""
    from featpipe.streaming.scoring import score_stream
    params, fitted = _artifact(spark, d)
    raw = _raw_rows(_examples(spark, d))
    src = scratch_path(spark, "stream-src")
    raw.write.parquet(src)
    return score_stream(spark, src, raw.schema, params, fitted, scratch_path(spark, "stream-sink"),
                        scratch_path(spark, "stream-ckpt"), keep=tuple(raw.columns))


def _baseline_scored(spark, d):
    """Deterministic predictor for exact metric checks: the mean of the
    (filled) training label, as a scalar subquery."""
    e = _examples(spark, d)
    mean = e.where(F.col("split") == "train").select(F.avg(F.coalesce(F.col(LABEL_KEY), F.lit(0.0)))).scalar()
    return e.where(F.col("split") == "eval").withColumn("prediction", mean)


def _metrics_cols(m):
    return m.select(fixed(evaluate.MAE, MAE_PLACES).alias(evaluate.MAE),
                    fixed(evaluate.MSE, MSE_PLACES).alias(evaluate.MSE),
                    "n", "n_missing_label")


def q_eval_metrics(spark, d):
    return _metrics_cols(evaluate.eval_metrics(_baseline_scored(spark, d), LABEL_KEY))


SLICES = ((), ("month",), ("day",), ("month", "day"))


def q_eval_metrics_sliced(spark, d):
    """Overall, by month, by day and by both, in one pass."""
    m = evaluate.eval_metrics_sliced(_baseline_scored(spark, d), LABEL_KEY, SLICES)
    return m.select("slice", "value", fixed(evaluate.MAE, MAE_PLACES).alias(evaluate.MAE),
                    fixed(evaluate.MSE, MSE_PLACES).alias(evaluate.MSE), "n", "n_missing_label")


def q_quality_gate(spark, d):
    g = evaluate.quality_gate(evaluate.eval_metrics(_baseline_scored(spark, d), LABEL_KEY))
    return g.withColumn("value", F.when(F.col("metric") == evaluate.MAE, fixed("value", MAE_PLACES))
                        .otherwise(fixed("value", MSE_PLACES)))


def q_gated_publish(spark, d):
    """The deterministic predictor under the default bounds and under wide
    ones: (name, blessed, published, reads_back)."""
    params, fitted, _ = _fitted_model(spark, d)
    metrics = bounded_local(evaluate.eval_metrics(_baseline_scored(spark, d), LABEL_KEY), 1)

    def save(p):
        features.save_params(params, f"{p}/transform")
        model.save_model(fitted, f"{p}/model")

    registry, out = scratch_path(spark, "registry"), None
    for name, thresholds in (("default", evaluate.DEFAULT_THRESHOLDS), ("wide", [(evaluate.MAE, 0.0, 1e15)])):
        row = evaluate.gated_publish(spark, evaluate.quality_gate(metrics, thresholds), registry, name, save)
        path = row.first()["path"]
        back = path is not None and features.load_params(spark, f"{path}/transform").spec == params.spec and (
            len(model.load_model(f"{path}/model").stages) == len(fitted.stages))
        row = row.select("name", "blessed", "published", F.lit(back).alias("reads_back"))
        out = row if out is None else out.union(row)
    return out


def q_latest_artifact(spark, d):
    o = read_table(spark, d, "orders")
    manifest = o.select(F.concat(F.lit("c"), F.col("o_custkey")).alias("name"),
                        F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("update_time"),
                        F.col("o_totalprice").alias("total"))
    latest = evaluate.latest_artifact(manifest, "name", "update_time", "version")
    return latest.select("name", "version", epoch_seconds("update_time").alias("update_time"), "total")


def _images(spark, d):
    return model.image_split(read_table(spark, d, "embeddings"))


def q_classify_fit(spark, d):
    """Accuracy and rows per split of the fitted classifier."""
    e = _images(spark, d)
    dim = len(e.select("embedding").first()[0])
    m = model.classify_fit(e.where(F.col("split") == "train"), dim, 10, hidden=512, max_iter=100)
    return model.accuracy(model.classify_predict(m, e))


def q_vector_rescale(spark, d):
    r = model.vector_rescale(read_table(spark, d, "embeddings"), "embedding", out="scaled")
    v = F.col("scaled")
    return r.select("vec_id", F.size(v).cast("bigint").alias("n"), F.array_min(v).alias("min_value"),
                    F.array_max(v).alias("max_value"),
                    fixed(F.aggregate(v, F.lit(0.0), lambda a, b: a + b), 6).alias("sum_value"))


PART_TOP_K = 100   # small cap so that the cap binds and unknown buckets occur


def _part_params(spark, d):
    li = read_table(spark, d, "lineitem")
    spec = features.FeatureSpec(numeric=(), categorical=("l_partkey",), label=None, top_k=PART_TOP_K)
    return li, features.fit(li, spec)


def q_vocab_topk_cap(spark, d):
    """Vocabulary of part keys over all of ``lineitem`` capped at 100 tokens:
    many keys tie in frequency, so the tie rule decides the cap boundary."""
    return _part_params(spark, d)[1].vocab


def q_vocab_oov_apply(spark, d):
    li, params = _part_params(spark, d)
    out = features.apply_vocabulary(li.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey",
                                    params, "l_partkey_idx")
    return out.select("l_orderkey", "l_linenumber", features.token("l_partkey").alias("token"), "l_partkey_idx")


def _outcome(res):
    """What a finished run decided: gate rows with the published state, and the checks that failed."""
    published = res.manifest_row.select("published").scalar()
    gate = res.gate.select(F.lit("gate").alias("part"), F.lit("eval").alias("split"), F.col("metric").alias("name"), "value", "ok",
                           "blessed", published.alias("published"))
    found = res.report.where(~F.col("ok")).select(
        F.lit("anomaly").alias("part"), "split", F.concat_ws(":", "column", "check").alias("name"),
        F.col("n_bad").cast("double").alias("value"), "ok", F.lit(None).cast("boolean").alias("blessed"),
        F.lit(None).cast("boolean").alias("published"))
    return gate.unionByName(found)


def q_tabular_pipeline(spark, d):
    """The source's component chain end to end, from CSV files; its gate and its anomalies."""
    from featpipe.plans.training import run_pipeline
    path = csv_src.write_csv(trips(spark, d), scratch_path(spark, "trips-csv"))
    return _outcome(run_pipeline(spark, csv_src.read_csv_typed(spark, path), scratch_path(spark, "registry")))


def q_tabular_hooks(spark, d):
    """The chain with a user's preprocessing and a user's estimator."""
    from pyspark.ml.regression import GBTRegressor

    from featpipe.plans.training import run_pipeline
    trees = GBTRegressor(featuresCol="features", labelCol=LABEL_KEY, maxIter=2, maxDepth=3, seed=7)
    known = lambda raw: raw.where(F.col(LABEL_KEY).isNotNull())
    return _outcome(run_pipeline(spark, trips(spark, d), scratch_path(spark, "registry"), preprocess=known, estimator=trees))


def _large_params(spark, d):
    li = read_table(spark, d, "lineitem")
    li = li.withColumn("order_part", F.concat_ws("-", F.when(F.col("l_linenumber") != 3, F.col("l_orderkey")), "l_partkey"))
    spec = features.FeatureSpec(numeric=(), categorical=("order_part",), label=None, top_k=LARGE_TOP_K)
    return li, features.fit(li.where("l_linenumber < 6"), spec)


LARGE_TOP_K = 1_000_000   # as large as a vocabulary gets: written, ranked by prefix sums, joined by shuffle


def q_vocab_large(spark, d):
    """Fit and apply with room for a million tokens: index of every line's order and part, unseen ones in buckets."""
    li, params = _large_params(spark, d)
    out = features.apply_vocabulary(li.select("l_orderkey", "l_linenumber", "order_part"), "order_part", params, "order_part_idx")
    return out.select("l_orderkey", "l_linenumber", "order_part", "order_part_idx")


QUERIES = {
    "csv_ingest": q_csv_ingest,
    "hash_split": q_hash_split,
    "column_stats": q_column_stats,
    "column_quantiles": q_column_quantiles,
    "column_histogram": q_column_histogram,
    "column_topk": q_column_topk,
    "infer_schema": q_infer_schema,
    "validate_examples": q_validate_examples,
    "validate_drifted": q_validate_drifted,
    "fill_missing": q_fill_missing,
    "zscore": q_zscore,
    "vocab_fit": q_vocab_fit,
    "vocab_apply": q_vocab_apply,
    "one_hot": q_one_hot,
    "preprocess": q_preprocess,
    "assemble_features": q_assemble_features,
    "fit_apply_splits": q_fit_apply_splits,
    "transform_saved": q_transform_saved,
    "transformed_roundtrip": q_transformed_roundtrip,
    "transformed_roundtrip_all": q_transformed_roundtrip_all,
    "artifact_roundtrip": q_artifact_roundtrip,
    "regress_fit": q_regress_fit,
    "score_batch": q_score_batch,
    "score_stream": q_score_stream,
    "eval_metrics": q_eval_metrics,
    "eval_metrics_sliced": q_eval_metrics_sliced,
    "quality_gate": q_quality_gate,
    "gated_publish": q_gated_publish,
    "latest_artifact": q_latest_artifact,
    "classify_fit": q_classify_fit,
    "vector_rescale": q_vector_rescale,
    "tabular_pipeline": q_tabular_pipeline,
    "tabular_hooks": q_tabular_hooks,
    "vocab_topk_cap": q_vocab_topk_cap,
    "vocab_oov_apply": q_vocab_oov_apply,
    "vocab_large": q_vocab_large,
}

# ---------------------------------------------------------------- oracles


def _q(c):
    return f'"{c}"'


_KINDS = [(c, "numeric") for c in NUMERIC_FEATURE_KEYS] + [("month", "numeric"), ("day", "text"),
                                                            (LABEL_KEY, "numeric")]
assert [c for c, _ in _KINDS] == TRIP_COLUMNS
_NUM_ALL = NUMERIC_FEATURE_KEYS + ["month", LABEL_KEY]

_EX = (f"trips AS ({TRIPS_SQL}),\n"
       f"ex AS (SELECT *, {ex.split_sql([(_q(c), k) for c, k in _KINDS])} AS split FROM trips)")

_FILLED = ("filled AS (SELECT split, "
           + ", ".join(f"coalesce({_q(c)}, 0) AS {_q(c)}" for c in _NUM_ALL)
           + ", coalesce(\"day\", '') AS \"day\" FROM ex)")

_MOM = ("mom AS (SELECT " + ", ".join(f"avg({_q(c)}) AS m_{c}, stddev_pop({_q(c)}) AS s_{c}"
                                      for c in SPEC.numeric)
        + " FROM filled WHERE split = 'train')")


def _z(c):
    return f"(CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN {_q(c)} - m_{c} ELSE ({_q(c)} - m_{c}) / s_{c} END)"


_VOCAB = f"""
tok AS (SELECT split, 'month' AS feature, CAST(month AS VARCHAR) AS token FROM filled
        UNION ALL SELECT split, 'day', "day" FROM filled),
freq AS (SELECT feature, token, count(*) AS freq FROM tok
         WHERE split = 'train' AND token <> '' AND NOT regexp_matches(token, '[\\n\\r]') GROUP BY 1, 2),
vocab AS (SELECT feature, token, CAST(idx AS INTEGER) AS idx, freq FROM (
          SELECT *, row_number() OVER (PARTITION BY feature ORDER BY freq DESC, token DESC) - 1 AS idx FROM freq)
          WHERE idx < {SPEC.top_k}),
vsize AS (SELECT count(*) FILTER (WHERE feature = 'month') AS size_month,
                 count(*) FILTER (WHERE feature = 'day') AS size_day FROM vocab)"""


def _bucket(expr):
    return ex.bucket_sql(expr, SPEC.oov_buckets)


_IDX = f"""
idx AS (SELECT f.*,
  CAST(coalesce(vm.idx, vs.size_month + {_bucket('CAST(f.month AS VARCHAR)')}) AS INTEGER) AS month_xf_idx,
  CAST(coalesce(vd.idx, vs.size_day + {_bucket('f."day"')}) AS INTEGER) AS day_xf_idx,
  vs.size_month + {SPEC.oov_buckets} AS depth_month, vs.size_day + {SPEC.oov_buckets} AS depth_day
  FROM filled f CROSS JOIN vsize vs
  LEFT JOIN vocab vm ON vm.feature = 'month' AND vm.token = CAST(f.month AS VARCHAR)
  LEFT JOIN vocab vd ON vd.feature = 'day' AND vd.token = f."day")"""

_T_BASE = f"WITH {_EX},\n{_FILLED},\n{_MOM},{_VOCAB},{_IDX}\n"


def _compact_sql(src="idx, mom", where=""):
    cols = ["split"] + [f"{fixed_sql(_z(c), 6)} AS {XF(c)}" for c in SPEC.numeric]
    for c in SPEC.categorical:
        cols += [f"CAST(depth_{c} AS BIGINT) AS {XF(c)}_depth", f"CAST({XF(c)}_idx AS BIGINT) AS {XF(c)}_hot",
                 f"CAST(1 AS BIGINT) AS {XF(c)}_nnz"]
    cols.append(f"CAST({LABEL_KEY} AS DOUBLE) AS {LABEL_KEY}")
    return f"SELECT {', '.join(cols)} FROM {src} {where}"


def _stats_sql():
    parts = []
    for c, kind in _KINDS:
        qc = _q(c)
        if kind == "text":
            parts.append(f"""SELECT split, '{c}' AS "column", 'BYTES' AS type, count({qc}) AS count,
  count(*) - count({qc}) AS missing, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std_dev, CAST(NULL AS DOUBLE) AS zeros,
  CAST(count(DISTINCT {qc}) AS DOUBLE) AS "distinct", {fixed_sql(f'avg(length({qc}))', 6)} AS avg_length
FROM ex GROUP BY split""")
        else:
            t = "INT" if c == "month" else "FLOAT"
            x = f"CAST({qc} AS DOUBLE)"
            parts.append(f"""SELECT split, '{c}' AS "column", '{t}' AS type, count({qc}) AS count,
  count(*) - count({qc}) AS missing, min({x}) AS min, max({x}) AS max,
  {fixed_sql(f'avg({x})', 4)} AS mean, {fixed_sql(f'stddev_pop({x})', 4)} AS std_dev,
  CAST(count(*) FILTER (WHERE {x} = 0) AS DOUBLE) AS zeros, CAST(NULL AS DOUBLE) AS "distinct",
  CAST(NULL AS DOUBLE) AS avg_length FROM ex GROUP BY split""")
    return f"WITH {_EX}\n" + "\nUNION ALL\n".join(parts)


def _hist_sql():
    num = [c for c, k in _KINDS if k == "numeric"]
    b = profile.HISTOGRAM_BUCKETS
    parts = []
    for c in num:
        x = f"CAST({_q(c)} AS DOUBLE)"
        parts.append(f"""SELECT s.split, '{c}' AS "column", CAST(k.range AS INTEGER) AS bucket,
  s.mn + ((s.mx - s.mn) / CAST({b} AS DOUBLE)) * k.range AS low,
  CASE WHEN k.range = {b - 1} THEN s.mx ELSE s.mn + ((s.mx - s.mn) / CAST({b} AS DOUBLE)) * (k.range + 1) END AS high,
  (SELECT count(*) FROM ex e WHERE e.split = s.split AND
     (CASE WHEN {x} IS NULL THEN NULL WHEN s.mx = s.mn THEN 0 ELSE least(floor(({x} - s.mn) / (s.mx - s.mn) * CAST({b} AS DOUBLE)), {b - 1}) END)
     = k.range) AS count
FROM (SELECT split, min({x}) AS mn, max({x}) AS mx FROM ex GROUP BY split) s CROSS JOIN range({b}) k""")
    return f"WITH {_EX}\n" + "\nUNION ALL\n".join(parts)


def _topk_sql():
    return f"""WITH {_EX},
f AS (SELECT split, 'month' AS "column", CAST(month AS VARCHAR) AS value, count(*) AS freq FROM ex
      WHERE month IS NOT NULL GROUP BY 1, 3
      UNION ALL SELECT split, 'day', "day", count(*) FROM ex WHERE "day" IS NOT NULL GROUP BY 1, 3)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY split, "column" ORDER BY freq DESC, value ASC)
                              AS INTEGER) AS rank FROM f) WHERE rank <= {TOPK_VALUES}"""


def _schema_sql():
    rows = []
    for c, kind in _KINDS:
        t = "BYTES" if kind == "text" else ("INT" if c == "month" else "FLOAT")
        dom = (f"CAST(CASE WHEN count(DISTINCT {_q(c)}) <= {profile.MAX_STRING_DOMAIN} "
               f"THEN count(DISTINCT {_q(c)}) END AS DOUBLE)" if kind == "text" else "CAST(NULL AS DOUBLE)")
        rows.append(f"""SELECT '{c}' AS "column", '{t}' AS type, count(*) = count({_q(c)}) AS required,
  CASE WHEN count(*) = count({_q(c)}) THEN 1.0 ELSE 0.0 END::DOUBLE AS min_fraction, {dom} AS domain_size
FROM ex WHERE split = 'train'""")
    return rows


def _validate_sql():
    parts = []
    for c, kind in _KINDS:
        qc = _q(c)
        parts.append(f"""SELECT s.split, '{c}' AS "column", 'presence' AS "check",
  CAST(CASE WHEN r.required AND s.missing > 0 THEN s.missing ELSE 0 END AS BIGINT) AS n_bad,
  NOT (r.required AND s.missing > 0) AS ok
FROM (SELECT split, count(*) - count({qc}) AS missing FROM ex GROUP BY split) s,
     (SELECT count(*) = count({qc}) AS required FROM ex WHERE split = 'train') r
UNION ALL SELECT split, '{c}', 'type', CAST(0 AS BIGINT), TRUE FROM ex GROUP BY split""")
    parts.append("""SELECT s.split, 'day', 'domain',
  (SELECT count(*) FROM ex e WHERE e.split = s.split AND e."day" IS NOT NULL
     AND e."day" NOT IN (SELECT "day" FROM ex WHERE split = 'train' AND "day" IS NOT NULL)), NULL
FROM (SELECT DISTINCT split FROM ex) s""")
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH {_EX}, v AS ({body})
SELECT split, "column", "check", n_bad, coalesce(ok, n_bad = 0) AS ok FROM v"""


def _quantiles_sql():
    parts = []
    for c in _NUM_ALL:
        x = f"CAST({_q(c)} AS DOUBLE)"
        parts.append(f"""SELECT split, '{c}' AS "column", """ + ", ".join(
            f"min(x) FILTER (WHERE rn >= greatest(ceil({p} * n), 1)) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75)) + f"""
FROM (SELECT split, {x} AS x, row_number() OVER (PARTITION BY split ORDER BY {x}) AS rn, count(*) OVER (PARTITION BY split) AS n
      FROM ex WHERE {_q(c)} IS NOT NULL) GROUP BY split""")
    return f"WITH {_EX}\n" + "\nUNION ALL\n".join(parts)


def _drifted_sql():
    """Every check of the drifted rows, from the clean ones."""
    changed = {"day": "CASE WHEN split = 'eval' THEN 'x' || \"day\" ELSE \"day\" END",
               "pickup_longitude": f"CASE WHEN split <> 'eval' OR month <> {DRIFT_MONTH} THEN pickup_longitude END"}
    parts = ["SELECT split, 'pickup_latitude' AS \"column\", 'missing_column' AS \"check\", CAST(0 AS BIGINT) AS n_bad, "
             "FALSE AS ok FROM ex GROUP BY split",
             "SELECT split, 'extra', 'unknown_column', count(*), FALSE FROM ex GROUP BY split"]
    zone = "'z' || CAST(CAST(floor(pickup_longitude) AS BIGINT) AS VARCHAR)"
    parts.append(f"""SELECT s.split, 'zone', 'presence', CASE WHEN r.required THEN s.missing ELSE 0 END, NOT (r.required AND s.missing > 0)
FROM (SELECT split, count(*) - count(pickup_longitude) AS missing FROM ex GROUP BY split) s,
     (SELECT count(*) = count(pickup_longitude) AS required FROM ex WHERE split = 'train') r
UNION ALL SELECT split, 'zone', 'type', 0, TRUE FROM ex GROUP BY split
UNION ALL SELECT split, 'zone', 'domain', count(*) FILTER (WHERE unseen), count(*) FILTER (WHERE unseen) = 0 FROM (
  SELECT split, now IS NOT NULL AND now NOT IN (SELECT {zone} FROM ex WHERE split = 'train' AND pickup_longitude IS NOT NULL) AS unseen
  FROM (SELECT split, {zone} || CASE WHEN split = 'eval' AND month = {DRIFT_MONTH} THEN 'x' ELSE '' END AS now FROM ex)) GROUP BY split""")
    for c, _ in _KINDS:
        if c == "pickup_latitude":
            continue
        now = changed.get(c, _q(c))
        retyped = c == "euclidean"
        parts.append(f"""SELECT s.split, '{c}', 'presence', CASE WHEN r.required THEN s.missing ELSE 0 END,
  NOT (r.required AND s.missing > 0)
FROM (SELECT split, count(*) - count({now}) AS missing FROM ex GROUP BY split) s,
     (SELECT count(*) = count({_q(c)}) AS required FROM ex WHERE split = 'train') r
UNION ALL SELECT split, '{c}', 'type', {f'count({now})' if retyped else '0'}, {'FALSE' if retyped else 'TRUE'} FROM ex GROUP BY split""")
    parts.append("""SELECT s.split, 'day', 'domain', s.n, s.n = 0 FROM (
  SELECT split, count(*) FILTER (WHERE now IS NOT NULL AND now NOT IN (SELECT "day" FROM ex WHERE split = 'train' AND "day" IS NOT NULL)) AS n
  FROM (SELECT split, """ + changed["day"] + """ AS now FROM ex) GROUP BY split) s""")
    return f"WITH {_EX}\n" + "\nUNION ALL\n".join(parts)


def _assemble_sql():
    cols = [f"CAST(depth_day + depth_month + {len(SPEC.numeric)} AS BIGINT) AS n_features"]
    for name in features.feature_order(SPEC):
        src = name[: -len(features.SUFFIX)]
        if src in SPEC.categorical:
            cols += [f"CAST({src}_xf_idx AS BIGINT) AS {name}_hot", f"CAST(1 AS BIGINT) AS {name}_nnz"]
        else:
            cols.append(f"{fixed_sql(_z(src), 6)} AS {name}")
    return (_T_BASE + f"SELECT split, {', '.join(cols)}, CAST({LABEL_KEY} AS DOUBLE) AS {LABEL_KEY} "
            "FROM idx, mom")


_BASELINE = f"""WITH {_EX},
base AS (SELECT avg(coalesce({LABEL_KEY}, 0)) AS p FROM ex WHERE split = 'train'),
m AS (SELECT avg(abs(p - {LABEL_KEY})) AS mae, avg((p - {LABEL_KEY}) * (p - {LABEL_KEY})) AS mse,
             count({LABEL_KEY}) AS n, count(*) FILTER (WHERE {LABEL_KEY} IS NULL) AS n_missing_label
      FROM ex, base WHERE split = 'eval')
"""

_PART_VOCAB = f"""
pf AS (SELECT CAST(l_partkey AS VARCHAR) AS token, count(*) AS freq FROM lineitem
       WHERE l_partkey IS NOT NULL GROUP BY 1),
pv AS (SELECT 'l_partkey' AS feature, token, CAST(idx AS INTEGER) AS idx, freq FROM (
       SELECT *, row_number() OVER (ORDER BY freq DESC, token DESC) - 1 AS idx FROM pf) WHERE idx < {PART_TOP_K})"""

ORACLE = {
    "gated_publish": """SELECT * FROM (VALUES ('default', FALSE, FALSE, FALSE), ('wide', TRUE, TRUE, TRUE))
AS t(name, blessed, published, reads_back)""",
    "csv_ingest": f"SELECT * REPLACE (CAST(month AS BIGINT) AS month) FROM ({TRIPS_SQL})",
    "hash_split": f"WITH {_EX} SELECT * FROM ex",
    "column_stats": _stats_sql(),
    "column_histogram": _hist_sql(),
    "column_topk": _topk_sql(),
    "infer_schema": f"WITH {_EX}\n" + "\nUNION ALL\n".join(_schema_sql()),
    "column_quantiles": _quantiles_sql(),
    "validate_examples": _validate_sql(),
    "validate_drifted": _drifted_sql(),
    "fill_missing": f"WITH {_EX},\n{_FILLED}\nSELECT * FROM filled",
    "zscore": f"WITH {_EX},\n{_FILLED},\n{_MOM}\nSELECT split, "
              + ", ".join(f"{fixed_sql(_z(c), 6)} AS {XF(c)}" for c in SPEC.numeric) + " FROM filled, mom",
    "vocab_fit": f"WITH {_EX},\n{_FILLED},{_VOCAB}\nSELECT feature, token, idx, freq FROM vocab",
    "vocab_apply": _T_BASE + "SELECT split, CAST(month AS VARCHAR) AS month_token, \"day\" AS day_token, "
                             "month_xf_idx, day_xf_idx FROM idx",
    "one_hot": _T_BASE + "SELECT split, " + ", ".join(
        f"CAST(depth_{c} AS BIGINT) AS {XF(c)}_depth, CAST({XF(c)}_idx AS BIGINT) AS {XF(c)}_hot, "
        f"CAST(1 AS BIGINT) AS {XF(c)}_nnz" for c in SPEC.categorical) + " FROM idx",
    "preprocess": _T_BASE + _compact_sql(),
    "assemble_features": _assemble_sql(),
    "fit_apply_splits": _T_BASE + "SELECT split, count(*) AS n, " + ", ".join(
        f"{fixed_sql(f'avg({_z(c)})', 6)} AS mean_{XF(c)}" for c in SPEC.numeric) + ", "
        + ", ".join(f"count(*) FILTER (WHERE {XF(c)}_idx >= depth_{c} - {SPEC.oov_buckets}) AS oov_{c}"
                    for c in SPEC.categorical) + " FROM idx, mom GROUP BY split",
    "transform_saved": _T_BASE + _compact_sql(),
    "transformed_roundtrip": _T_BASE + _compact_sql(where="WHERE split = 'eval'"),
    "transformed_roundtrip_all": _T_BASE + _compact_sql(),
    "eval_metrics": _BASELINE + f"SELECT {fixed_sql('mae', MAE_PLACES)} AS mean_absolute_error, "
                                f"{fixed_sql('mse', MSE_PLACES)} AS mean_squared_error, n, n_missing_label FROM m",
    "eval_metrics_sliced": _BASELINE.replace("\nm AS", "\ncells AS (SELECT *, coalesce(CAST(month AS VARCHAR), 'NULL') AS mo, "
                                             "coalesce(\"day\", 'NULL') AS da FROM ex, base WHERE split = 'eval'),\nm AS") + f"""
SELECT CASE WHEN grouping(mo) = 0 AND grouping(da) = 0 THEN 'month,day' WHEN grouping(mo) = 0 THEN 'month'
            WHEN grouping(da) = 0 THEN 'day' ELSE '' END AS slice,
       CASE WHEN grouping(mo) = 0 AND grouping(da) = 0 THEN mo || ',' || da WHEN grouping(mo) = 0 THEN mo
            WHEN grouping(da) = 0 THEN da ELSE '' END AS value,
       {fixed_sql(f'avg(abs(p - {LABEL_KEY}))', MAE_PLACES)} AS mean_absolute_error,
       {fixed_sql(f'avg((p - {LABEL_KEY}) * (p - {LABEL_KEY}))', MSE_PLACES)} AS mean_squared_error,
       count({LABEL_KEY}) AS n, count(*) FILTER (WHERE {LABEL_KEY} IS NULL) AS n_missing_label
FROM cells GROUP BY GROUPING SETS ((), (mo), (da), (mo, da))""",
    "quality_gate": _BASELINE + f""",
g AS (SELECT 'mean_absolute_error' AS metric, {fixed_sql('mae', MAE_PLACES)} AS value, CAST(1.0 AS DOUBLE) AS lower_bound,
             CAST(4.0 AS DOUBLE) AS upper_bound, mae IS NOT NULL AND mae >= 1.0 AND mae <= 4.0 AS ok FROM m
      UNION ALL
      SELECT 'mean_squared_error', {fixed_sql('mse', MSE_PLACES)}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), TRUE FROM m)
SELECT *, (SELECT count(*) FROM g WHERE NOT ok) = 0 AS blessed FROM g""",
    "latest_artifact": f"""SELECT name, version, {"CAST(floor(epoch_us(update_time) / 1000000) AS BIGINT)"} AS update_time, total
FROM (SELECT 'c' || o_custkey AS name, o_orderkey AS version, o_orderdate AS update_time, o_totalprice AS total,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""",
    "vocab_topk_cap": f"WITH {_PART_VOCAB} SELECT * FROM pv",
    "vocab_oov_apply": f"""WITH {_PART_VOCAB}
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_partkey AS VARCHAR) AS token,
       CAST(coalesce(pv.idx, (SELECT count(*) FROM pv) + {_bucket('CAST(l.l_partkey AS VARCHAR)')}) AS INTEGER)
         AS l_partkey_idx
FROM lineitem l LEFT JOIN pv ON pv.token = CAST(l.l_partkey AS VARCHAR)""",
    "vocab_large": f"""WITH lines AS (
  SELECT *, CASE WHEN l_linenumber <> 3 THEN l_orderkey || '-' ELSE '' END || l_partkey AS order_part FROM lineitem),
lf AS (SELECT order_part AS token, count(*) AS freq FROM lines WHERE l_linenumber < 6 GROUP BY 1),
lv AS (SELECT token, row_number() OVER (ORDER BY freq DESC, token DESC) - 1 AS idx FROM lf)
SELECT l.l_orderkey, l.l_linenumber, l.order_part,
       CAST(coalesce(lv.idx, (SELECT count(*) FROM lv) + {_bucket('l.order_part')}) AS INTEGER) AS order_part_idx
FROM lines l LEFT JOIN lv ON lv.token = l.order_part""",
    "vector_rescale": f"""SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n,
  list_min(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / CAST(255 AS DOUBLE))) AS min_value,
  list_max(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / CAST(255 AS DOUBLE))) AS max_value,
  {fixed_sql("list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / CAST(255 AS DOUBLE)))", 6)} AS sum_value
FROM embeddings""",
}
