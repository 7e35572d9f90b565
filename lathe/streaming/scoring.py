"""Applying fitted state to streams.

Every fitted ``transform`` in lathe is a projection of literals and built-in
expressions (no window, no aggregate), so it runs unchanged on a streaming
DataFrame. These helpers read a table as a file stream and run a scoring
query to completion with ``trigger(availableNow=True)``, writing Parquet to
the shared checkpoint folder (the stream's own checkpoint goes there too, so
a restarted query resumes where it stopped).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lathe.session import scratch_path


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table read as a Parquet file stream (schema taken from the batch file)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


def run_available_now(stream: DataFrame, name: str = "stream-out", output_path: str | None = None) -> str:
    """Write a streaming frame to Parquet, processing everything available, then stop."""
    spark = stream.sparkSession
    out = output_path or scratch_path(spark, name)
    ckpt = scratch_path(spark, f"{name}-checkpoint")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def score_stream(spark: SparkSession, stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                 name: str = "scored") -> DataFrame:
    """Apply a fitted transform to a stream, run it to completion, return the written result."""
    path = run_available_now(transform(stream), name)
    return spark.read.parquet(path)
