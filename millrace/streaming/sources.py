"""Streaming scans of folders that receive new files.

A file source sees new files, not the growth of old ones: writers add chunks, and
the order of lines is in the data (``line_no``), never in file positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "run_id long, line_no long, at_us long, line string"


def log_stream(
    spark: SparkSession, path: str, schema: str = LOG_SCHEMA, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Log lines ``(run_id, line_no, at_us, line)`` of the chunks below ``path``."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def raw_log_stream(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line)`` of text chunks, for parsers that need no order."""
    lines = spark.readStream.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def message_stream(spark: SparkSession, queue: str, schema: str) -> DataFrame:
    """Messages of a queue: a folder of Parquet files."""
    return spark.readStream.schema(schema).parquet(queue)


def publish(messages: DataFrame, queue: str) -> None:
    """Append messages to a queue."""
    messages.write.mode("append").parquet(queue)
