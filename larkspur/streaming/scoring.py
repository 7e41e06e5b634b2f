"""Scoring of arriving files with a saved model, and merging of corrected labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    spark: SparkSession, in_path: str, schema, model: PipelineModel, out_path: str, checkpoint: str, keep: Sequence[str], files_per_trigger: int = 1000
) -> StreamingQuery:
    """Score every file that arrives under `in_path` once and append the predictions; runs until the
    files present are done, then stops. The checkpoint makes a restart go on where it stopped."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(in_path)
    scored = model.transform(rows).select(*keep, "prediction")
    return (
        scored.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out_path)
    )


def merge_corrections(train: DataFrame, corrections: DataFrame, key: str, label: str, at: str) -> DataFrame:
    """Training labels with the latest correction per key in place; corrected keys not yet in the
    training table are added."""
    latest = corrections.groupBy(key).agg(F.max_by(label, at).alias("_new"))
    joined = train.select(key, label).join(latest, key, "full")
    return joined.select(key, F.coalesce("_new", label).alias(label))
