"""Message stages: each reads one queue and feeds the next; queues are folders of Parquet files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.plans import Run, running
from millrace.streaming.sources import message_stream


@dataclass(frozen=True)
class Stage:
    """A named step of a chain: ``body`` maps the messages it reads to those it sends."""

    name: str
    body: Callable[[DataFrame], DataFrame]


def start_stage(spark: SparkSession, stage: Stage, source: str, schema: str, target: str, **trigger) -> StreamingQuery:
    """Run a stage from queue to queue; its checkpoint stands beside the target."""
    return (
        stage.body(message_stream(spark, source, schema))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", f"{target}-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drain(query: StreamingQuery) -> None:
    """Wait until a query has read all that was in its queue."""
    query.processAllAvailable()
    query.stop()


def run_chain(spark: SparkSession, stages: Sequence[Stage], queue: str, schema: str, folder: str) -> DataFrame:
    """Run the stages one after another, each until its queue is drained; the last queue as a table."""
    for stage in stages:
        target = f"{folder}/{stage.name}"
        query = start_stage(spark, stage, queue, schema, target)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        result = spark.read.schema(stage.body(spark.createDataFrame([], schema)).schema).parquet(target)
        queue = target
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema.fields)
    return result


def consume(stream: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Hand every micro-batch of messages to a callback."""
    return (
        stream.writeStream.foreachBatch(callback)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class CountStop:
    """Count the messages of a stream, publish percent progress, and tell when ``expected`` is reached.

    Counts are a table with one row per batch, so a restarted stream goes on where it was.
    """

    def __init__(self, spark: SparkSession, expected: int, folder: str) -> None:
        self.spark, self.expected, self.folder = spark, expected, folder

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.folder}/counts/batch={batch_id}")

    def run(self, stream: DataFrame, poll_seconds: float = 1.0, **trigger) -> bool:
        """Consume until the source is drained or the expected count is reached; True if it was reached."""
        query = consume(stream, self, f"{self.folder}/checkpoint", **trigger)
        while not query.awaitTermination(poll_seconds):
            if query.lastProgress and self.reached():
                query.stop()
        return self.reached()

    def counts(self) -> DataFrame:
        return self.spark.read.schema("n long, batch long").parquet(f"{self.folder}/counts")

    def progress(self) -> DataFrame:
        """``(batch, n, percent)``: the share done after each micro-batch."""
        done = running(self.counts(), [], ["batch"], {"_total": Run("sum", F.col("n"))})
        return done.select("batch", "n", F.round(F.col("_total") * 100.0 / self.expected, 2).alias("percent"))

    def reached(self) -> bool:
        return (self.counts().agg(F.sum("n")).first()[0] or 0) >= self.expected


def window_sensor_stream(
    rows: DataFrame, width: str, delay: str, features: Sequence[str], keys: Sequence[str] = ("trip_id",), ts: str = "ts"
) -> DataFrame:
    """Tumbling event-time windows with row counts and feature means; rows later than ``delay`` are dropped."""
    return (
        rows.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), *keys)
        .agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"{f}_mean") for f in features])
        .select(*keys, F.col("window.start").alias("start"), "n", *[f"{f}_mean" for f in features])
    )

