"""M13 (stream half): score raw records arriving as files with Structured
Streaming. The transform is map-only after fitting (broadcast vocabulary
joins, literal moments), so the same ``apply`` runs on the stream; no state is
kept. The query checkpoints to the shared folder, so a restarted query resumes
where it stopped, and the file sink is exactly-once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from featpipe.operators.features import FittedParams
from featpipe.operators.model import score


def score_stream(spark: SparkSession, source: str, schema: T.StructType, params: FittedParams,
                 model: PipelineModel, sink: str, checkpoint: str, keep=(),
                 timeout_s: int | None = None, max_files: int | None = 1000) -> DataFrame:
    """Process every file present under ``source`` (``availableNow``) in
    batches of ``max_files`` files, write predictions to ``sink`` (Parquet),
    return the sink as a batch frame. There is no time limit unless
    ``timeout_s`` gives one. A sink that cannot be read is an error, unless no
    row arrived and the folder was never created."""
    reader = spark.readStream.schema(schema)
    raw = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(source)
    scored = score(model, raw, params, keep=keep)
    q = (scored.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError("stream scoring did not finish")
    if q.exception() is not None:
        raise q.exception()
    try:
        return spark.read.schema(scored.schema).parquet(sink)
    except AnalysisException as e:
        arrived = sum(p["numInputRows"] for p in q.recentProgress)
        if e.getCondition() != "PATH_NOT_FOUND" or arrived:
            raise
        return spark.createDataFrame([], scored.schema)
