"""Model fitting and scoring (M12, M13 batch, M18, P9, S5), re-aimed at Spark
ML estimators. The source's dense networks and Adam loop are single-machine
trainers; Spark ML fits distributed models on the same inputs:

  * regression on the concatenated transformed features (label excluded),
    squared loss: ``LinearRegression`` (normal equations: one distributed pass
    building X'X) or ``GBTRegressor``;
  * the image-style classifier: ``MultilayerPerceptronClassifier`` with one
    hidden layer and a softmax output.

Iterative fits read a materialised input (the written transformed examples),
so a pass never recomputes the transform, and GBT checkpoints its lineage in
the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.functions.keys import hash_bucket
from featpipe.operators.features import FeatureSpec, assemble_features, feature_order, to_vector, transformed_name

RESCALE = 255.0
#: Training rows of a partition that an iterative fit keeps in memory.
FIT_ROWS = 100_000


def with_feature_vector(df: DataFrame, spec: FeatureSpec, out: str = "features") -> DataFrame:
    return assemble_features(df, spec, "_features_arr").withColumn(out, to_vector("_features_arr")) \
        .drop("_features_arr")


def _is_indexed(df: DataFrame, spec: FeatureSpec) -> bool:
    return all(f"{transformed_name(c)}_idx" in df.columns and transformed_name(c) not in df.columns
               for c in spec.categorical) and bool(spec.categorical)


def _estimator(spec: FeatureSpec, algorithm: str, seed: int):
    if algorithm not in ("linear", "gbt"):
        raise ValueError(f"unknown algorithm {algorithm!r}: use 'linear', 'gbt' or pass an estimator")
    if algorithm == "gbt":
        return GBTRegressor(featuresCol="features", labelCol=spec.label, lossType="squared",
                            seed=seed, checkpointInterval=10)
    return LinearRegression(featuresCol="features", labelCol=spec.label, loss="squaredError")


def _dealt(rows: DataFrame) -> DataFrame:
    """Training rows in partitions of about ``FIT_ROWS``: trees keep every partition, binned, and read it whole."""
    wanted = -(-rows.count() // FIT_ROWS)
    return rows.repartition(wanted) if wanted > rows.rdd.getNumPartitions() else rows


def regress_fit(transformed: DataFrame, spec: FeatureSpec, algorithm: str = "linear",
                seed: int = 42, estimator=None) -> PipelineModel:
    """Fit on transformed training rows; returns a PipelineModel whose
    input is the transformed frame (it adds ``features`` and ``prediction``).
    ``estimator`` is any Spark ML estimator that reads ``features`` and the
    label column and adds ``prediction``; it takes the place of ``algorithm``.

    Dense input (``<col>_xf`` arrays) is assembled as an array and turned into
    a vector. Index input (``apply(..., onehot="index")``) is expanded inside
    the model: ``OneHotEncoder(dropLast=False)`` builds sparse vectors whose
    length comes from the column metadata (vocabulary + unknown buckets), and
    ``VectorAssembler`` concatenates everything in sorted-name order, the same
    layout as the dense form."""
    last = estimator if estimator is not None else _estimator(spec, algorithm, seed)
    if not isinstance(last, LinearRegression):
        transformed = _dealt(transformed)
    if _is_indexed(transformed, spec):
        idx = [f"{transformed_name(c)}_idx" for c in spec.categorical]
        enc = OneHotEncoder(inputCols=idx, outputCols=[transformed_name(c) for c in spec.categorical],
                            dropLast=False, handleInvalid="error")
        asm = VectorAssembler(inputCols=feature_order(spec), outputCol="features")
        return Pipeline(stages=[enc, asm, last]).fit(transformed)
    data = with_feature_vector(transformed, spec)
    return PipelineModel(stages=[last.fit(data)])


def predict(model: PipelineModel, transformed: DataFrame, spec: FeatureSpec) -> DataFrame:
    """M13 (batch half): transformed rows -> ``prediction``."""
    if isinstance(model.stages[0], OneHotEncoderModel):
        out = model.transform(transformed)
        return out.drop("features", *[transformed_name(c) for c in spec.categorical])
    return model.transform(with_feature_vector(transformed, spec)).drop("features")


def input_form(model: PipelineModel) -> str:
    """'index' when the model expands one-hot positions itself, else 'dense'."""
    return "index" if isinstance(model.stages[0], OneHotEncoderModel) else "dense"


def score(model: PipelineModel, raw: DataFrame, params, keep=("split",)) -> DataFrame:
    """Raw rows (label optional) -> saved transform -> prediction."""
    from featpipe.operators.features import apply
    return predict(model, apply(raw, params, keep=keep, onehot=input_form(model)), params.spec)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ------------------------------------------------------------------ P9, M18

def vector_rescale(df: DataFrame, col: str = "embedding", scale: float = RESCALE,
                   out: str | None = None) -> DataFrame:
    """Every element divided by ``scale``."""
    return df.withColumn(out or col, F.transform(F.col(col), lambda v: v / F.lit(scale)))


def image_split(df: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Stable 2:1 train/test split on the row id."""
    return df.withColumn("split", F.when(hash_bucket(F.col(id_col), 3) < 2, "train").otherwise("test"))


def classify_fit(train: DataFrame, n_features: int, n_classes: int, hidden: int = 512,
                 max_iter: int = 100, seed: int = 42, features: str = "embedding",
                 label: str = "label") -> PipelineModel:
    """One hidden layer + softmax over ``n_classes`` on rescaled vectors."""
    data = vector_rescale(train, features, out="_scaled").withColumn("features", to_vector("_scaled")) \
        .withColumn("_label", F.col(label).cast("double"))
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="_label",
                                         layers=[n_features, hidden, n_classes], maxIter=max_iter, seed=seed)
    return PipelineModel(stages=[mlp.fit(data)])


def classify_predict(model: PipelineModel, df: DataFrame, features: str = "embedding") -> DataFrame:
    data = vector_rescale(df, features, out="_scaled").withColumn("features", to_vector("_scaled"))
    return model.transform(data).drop("_scaled", "features", "rawPrediction", "probability")


def accuracy(pred: DataFrame, label: str = "label", by=("split",)) -> DataFrame:
    return pred.groupBy(*by).agg(
        F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))
