"""File-stream source (STR-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp: cast a zone-less one in the session zone (UTC)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def read_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | str,
    ts: str | None = None,
    glob: str | None = None,
    files_per_trigger: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Stream of the files in a directory, with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.load(directory)
    return event_time(df, ts) if ts else df
