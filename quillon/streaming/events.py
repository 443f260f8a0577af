"""Streaming aggregation over event tables and frames of containers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scratch import shared_path


def finish(stream: DataFrame, spark: SparkSession, mode: str, label: str) -> DataFrame:
    """Run a stream over what is there; the last complete result, read back from the shared folder."""
    out, schema = shared_path(spark, label), stream.schema
    state = shared_path(spark, label + "-state")
    sink = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        sink.format("parquet").option("path", out).start().awaitTermination()
    else:
        sink.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream with event time."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(spark: SparkSession, sf_dir: str, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events by tumbling window and type."""
    counts = event_stream(spark, sf_dir).withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"))
    flat = counts.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")
    return finish(flat, spark, "complete", "tumbling")


def sliding(spark: SparkSession, sf_dir: str, size: str = "2 hours", step: str = "1 hour") -> DataFrame:
    """Events by sliding window."""
    counts = event_stream(spark, sf_dir).withWatermark("ts", "1 day").groupBy(F.window("ts", size, step)).agg(F.count("*").alias("n"))
    return finish(counts.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "n"), spark, "complete", "sliding")


def frames(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a frame container, read as a stream."""
    lines = spark.readStream.format("archive").option("path", path).option("frames", "true").load()
    return finish(lines, spark, "append", "frames")
