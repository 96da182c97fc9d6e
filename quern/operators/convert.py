"""Conversion to training formats, and reproducible shuffles and splits."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import hash_number
from quern.scratch import stored


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def to_grpo(df: DataFrame, data_source: str, checklist_type: str, reference_col: str | None = None, keep: list[str] = ()) -> DataFrame:
    """(keep..., prompt, data_source, extra_info): absent and null columns count alike.

    prompt: `prompt`, else `question`, else empty. checklist: that of `extra_info`, else the column, else empty.
    reference: `reference_html`, else `reference`, else that of extra_info (or the column named).
    """
    prompt = F.coalesce(column_or_null(df, "prompt", "string"), column_or_null(df, "question", "string"), F.lit(""))
    extra = {f.name for f in df.schema["extra_info"].dataType.fields} if "extra_info" in df.columns else set()
    given = F.col("extra_info.checklist") if "checklist" in extra else F.lit(None).cast(checklist_type)
    checklist = F.coalesce(given, column_or_null(df, "checklist", checklist_type), F.array().cast(checklist_type))
    references = [column_or_null(df, c, "string") for c in ([reference_col] if reference_col else ["reference_html", "reference"])]
    if "reference" in extra:
        references.append(F.col("extra_info.reference"))
    info = F.struct(checklist.alias("checklist"), prompt.alias("question"), F.coalesce(*references).alias("reference"))
    return df.select(*keep, prompt.alias("prompt"), F.lit(data_source).alias("data_source"), info.alias("extra_info"))


def numbered(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """df with `name`, the row's place from 0 in the order of the columns.

    Rows are range-partitioned; each partition's rank is offset by the rows before it, so no task orders more than its
    own partition.
    """
    # Written first: ranges are drawn from a sample, and both uses below must see the same ones.
    parts = stored(df.repartitionByRange(*map(F.col, order)).withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("nth", nth).join(F.broadcast(before), "part").withColumn(name, F.col("before") + F.col("nth")).drop("part", "nth", "size", "before")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """df with `position`, a permutation of 0 .. n - 1 that depends on seed and key alone: the order of a hash."""
    return numbered(df.withColumn("mixed", hash_number(F.lit(str(seed)), key)), "mixed", key).drop("mixed")


def train_val_split(df: DataFrame, key: str, ratio: float = 0.9, seed: int = 42) -> DataFrame:
    """df with is_train: int(ratio * n) rows, chosen by a shuffle."""
    placed = stored(shuffled(df, key, seed))
    return placed.withColumn("is_train", F.col("position") < int(placed.count() * ratio)).drop("position")


def hash_split(df: DataFrame, key: str, ratio: float = 0.9, seed: int = 42) -> DataFrame:
    """df with is_train by a hash of the key: no shuffle, and a row's side never changes as the table grows."""
    return df.withColumn("is_train", F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) < int(ratio * 1_000_000))
