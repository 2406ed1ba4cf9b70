"""Newly landed tables, each record once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def new_records(spark: SparkSession, path: str, schema, key: str = "record_id", time: str = "observed_at", late: str = "30 days") -> DataFrame:
    """A stream of the records under path; a repeated key is dropped while it is no later than `late`, which bounds the state."""
    return spark.readStream.schema(schema).parquet(path).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def append(stream: DataFrame, path: str, checkpoint: str):
    """Write what has landed and stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
