"""Streaming scoring (O-59).

Records arriving one at a time become rows of a stream: the same fitted
``PipelineModel`` chain, rule fallback and verdict run as a stateless
micro-batch query.  No state store is needed; the checkpoint only records
which input files are done, so a restarted query (or one that lost
executors) resumes without scoring a file twice into the sink.

``score_stream`` scores with models that are loaded once.
``score_stream_refreshing`` looks up the current model version before each
micro-batch and loads models again when it has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskloom.operators import scoring
from riskloom.plans import jobs
from riskloom.sources import versions


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Parquet files landing in ``path`` as a stream (schema is required).

    ``maxFilesPerTrigger`` bounds each micro-batch, so a large backlog is
    worked off in pieces (``availableNow`` honours it) instead of one
    batch that must fit the cluster at once.
    """
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def _triggered(w: DataStreamWriter, available_now: bool, processing_time: str | None) -> StreamingQuery:
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")).start()


def score_stream(sdf: DataFrame, task: str, models: dict, key: str, out_path: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Score a stream into a parquet sink (append; exactly-once per file)."""
    scored = scoring.score_all(sdf, task, models, key)
    w = (scored.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    return _triggered(w, available_now, processing_time)


class BatchScorer:
    """Scores micro-batches with the current models below ``models_dir``.

    The version is looked up before each batch (one directory listing) and
    models are loaded only when it is another one.  A batch is written to a
    folder of its own number, replaced as a whole when it is repeated, so
    every row is in the sink once, scored by one version, which stands in
    ``model_version`` (0 before the first: rules answer).
    """

    def __init__(self, task: str, models_dir: str, key: str, out_path: str):
        self.task, self.models_dir, self.key, self.out_path = task, models_dir, key, out_path
        self.version: int | None = None
        self.models: dict = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number, folder = versions.current(spark, self.models_dir, self.task)
        if number != self.version:
            self.models, self.version = jobs.load_models(spark, folder), number
        scored = scoring.score_all(batch, self.task, self.models, self.key)
        scored.withColumn("model_version", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{self.out_path}/batch={batch_id}")


def score_stream_refreshing(sdf: DataFrame, task: str, models_dir: str, key: str, out_path: str, checkpoint: str,
                            available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Score a stream; each micro-batch uses the models that are current when it begins."""
    w = sdf.writeStream.foreachBatch(BatchScorer(task, models_dir, key, out_path)).option("checkpointLocation", checkpoint)
    return _triggered(w, available_now, processing_time)
