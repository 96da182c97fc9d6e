"""Files that arrive in portions, and streams over them that go on where they stopped."""

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame


def feed(portions: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], folder: str) -> DataFrame:
    """What the stream `build` appends while portions arrive in `folder`, each after the last one was worked through.

    Every portion is a query of its own from the same checkpoint: state, watermark and the list of files seen outlive it,
    as they outlive a restart. A portion may have any number of files. A watermark that a portion moves closes windows,
    sessions and join state before the next portion is read.
    """
    out = None
    for portion in portions:
        spark = portion.sparkSession
        portion.write.mode("append").parquet(f"{folder}/in")
        made = build(spark.readStream.schema(portion.schema).parquet(f"{folder}/in"))
        made.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
        out = spark.read.schema(made.schema).parquet(f"{folder}/out")
    return out
