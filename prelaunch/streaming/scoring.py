"""Incremental forms of two batch operators.

The reference is batch-only; these run the same operators as Structured
Streaming queries over a folder that receives new catalogue files:

* ``score_stream``  — MOD7: a saved ``PipelineModel`` scores each new
  micro-batch of feature rows; predictions are appended to Parquet with
  exactly-once file-sink semantics (the checkpoint tracks committed files).
* ``yearly_stats_stream`` — AGG6: running success rate and count per
  release year, kept in the state store and re-emitted on change.

Checkpoints must live on shared storage; by default they go under the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prelaunch.operators.deep_forest import DeepForestModel
from prelaunch.operators.models import deciding_model
from prelaunch.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the Parquet files that arrive in ``path`` (schema required)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def scored(stream: DataFrame, model: PipelineModel, key: str) -> DataFrame:
    """(key, proba, pred) per incoming row; the model is applied per micro-batch."""
    out = model.transform(stream)
    return out.select(key, vector_to_array("probability")[1].alias("proba"),
                      F.col("prediction").cast("int").alias("pred"))


def score_stream(spark: SparkSession, model_path: str, source: str, schema: T.StructType, key: str,
                 sink: str, checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Start the scoring query: new feature files in ``source`` -> predictions in ``sink`` (MOD7)."""
    model = PipelineModel.load(model_path)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", "score")
    new = read_stream(spark, source, schema)
    if isinstance(deciding_model(model), DeepForestModel):
        # its trees are joined in, so a micro-batch is scored as a table; one that comes again replaces its own folder
        w = new.writeStream.foreachBatch(lambda rows, n: scored(rows, model, key).write.mode("overwrite").parquet(f"{sink}/batch={n}")).option("checkpointLocation", ckpt)
    else:
        w = (scored(new, model, key).writeStream
             .format("parquet").option("path", sink).option("checkpointLocation", ckpt).outputMode("append"))
    if once:
        w = w.trigger(availableNow=True)
    return w.start()


def yearly_stats_stream(stream: DataFrame, target: str = "success", year: str = "release_year") -> DataFrame:
    """Running per-year success rate and target count (AGG6), update/complete mode."""
    return (stream.where(F.col(year).isNotNull()).groupBy(year)
            .agg(F.avg(F.col(target).cast("double")).alias("success_rate"),
                 F.count(target).alias("total_games")))
