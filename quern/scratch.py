"""Intermediate tables in the folder that all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may be broadcast.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset, a folder of this machine in local mode; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quern-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, few_bytes: int = 128 << 20) -> DataFrame:
    """Deal out a table that comes from fewer files than there are cores, unless they are large enough to be split."""
    cores, files = df.sparkSession.sparkContext.defaultParallelism, df.inputFiles()
    if len(files) >= cores:
        return df
    size = df.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] if files else 0
    return df.repartition(cores) if size < few_bytes * cores else df


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has at most `most` rows; the larger ones are joined by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def without(df: DataFrame, keys: DataFrame, on: list[str], most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of df whose values in `on` are not in keys; nulls equal nothing. keys is written first."""
    keys = stored(keys.select(*on).distinct())
    return df.join(small(keys, most), on, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def joined(df: DataFrame, names: DataFrame, on: list[str], crowd: int = 1000) -> DataFrame:
    """df joined with names, a written table with one row a key and `n`, the rows of df that have it.

    Keys of more than `crowd` rows are few, so they are broadcast (if their count allows it), and no task gets all rows
    of such a key; the rest meet by shuffle. n is dropped.
    """
    hot = names.where(F.col("n") > crowd).drop("n")
    if not 0 < hot.count() <= BROADCAST_ROWS:
        return df.join(names.drop("n"), on)
    cold = df.join(F.broadcast(hot.select(*on)), on, "left_anti").join(names.where(F.col("n") <= crowd).drop("n"), on)
    return df.join(F.broadcast(hot), on).unionByName(cold)


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; DataFrames that still read them can't be used afterwards."""
    jvm, folder = spark.sparkContext._jvm, shared_folder(spark)
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/quern-{spark.sparkContext.applicationId}-*")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(path) or []:
        fs.delete(status.getPath(), True)
