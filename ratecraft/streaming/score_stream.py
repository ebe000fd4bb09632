"""File-stream scoring: new parquet files in a folder -> predictions appended to a sink.

The model transform is a stateless projection, so every micro-batch is scored
independently; the checkpoint location makes the job restartable (exactly-once
file sink). Use ``trigger_once``/``available_now`` for catch-up batch runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ratecraft.operators.models import MultiTargetModel


def score_stream(spark: SparkSession, input_dir: str, schema: StructType | str, model_path: str,
                 output_dir: str, checkpoint_dir: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    model = MultiTargetModel.load(model_path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(input_dir)
    scored = model.predict(stream)
    w = (scored.writeStream.format("parquet").option("path", output_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
