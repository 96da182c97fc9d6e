"""Resumable stages and exact deduplication as Structured Streaming."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def resumable(spark: SparkSession, source: str, schema: str, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run a stage over parquet files as they arrive; what the checkpoint has seen is not asked for again.

    Each batch is written under its own number, so a repeated batch overwrites itself instead of adding rows.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedup(stream: DataFrame, keys: list[str], time_col: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key: ever, the state growing with the distinct keys, or, with a time column, within `late`
    of its first row, after which its state is dropped."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark(keys) if time_col else stream.dropDuplicates(keys)
