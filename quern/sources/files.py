"""Record files: JSON lines, parquet, trees, templates and category lists."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import safe_name, strip, without_line_label


def trial(rows: DataFrame, first: int | None) -> DataFrame:
    """rows, or for a trial run only `first` of them; every reader here takes this limit."""
    return rows if first is None else rows.limit(first)


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType | str, bad: str = "skip", first: int | None = None) -> DataFrame:
    """JSON lines under a declared schema; blank lines are no records.

    bad: `skip` drops lines that aren't JSON, `fail` raises on them, `keep` gives them in a column `_bad`.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if bad == "fail":
        return trial(spark.read.schema(schema).option("mode", "FAILFAST").json(path), first)
    # Parsed from text: the JSON reader refuses queries that need the bad lines alone, such as counts.
    lines = spark.read.text(path).where(strip(F.col("value")) != "")
    kept = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    found = lines.select(F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("r.*")
    return trial(found if bad == "keep" else found.where("_bad IS NULL").drop("_bad"), first)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, first: int | None = None) -> DataFrame:
    """Records by the suffix of the path: parquet, or JSON lines (which need a schema)."""
    return read_records(spark, path, schema, first=first) if path.endswith((".jsonl", ".json")) else trial(spark.read.parquet(path), first)


def read_parquet_folder(spark: SparkSession, folder: str, required: list[str], max_files: int | None = None, first: int | None = None) -> DataFrame:
    """The parquet files of a folder in order of their names, without unreadable ones and rows with an empty required column."""
    found = spark.read.option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", "true").parquet(folder)
    if max_files is not None:
        found = spark.read.option("ignoreCorruptFiles", "true").parquet(*sorted(found.inputFiles())[:max_files])
    for name in required:
        found = found.where(F.coalesce(F.col(name), F.lit("")) != "")
    return trial(found, first)


def read_templates(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Templates that have both a text and variables."""
    return trial(read_records(spark, path, "prompt_template string, variables array<string>").where("prompt_template IS NOT NULL AND variables IS NOT NULL"), first)


def read_categories(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Names of a text file, one a line, without line labels and blanks."""
    return trial(spark.read.text(path).select(without_line_label(F.col("value")).alias("name")).where("name <> ''"), first)


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines with nulls kept."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_by_root(df: DataFrame, path: str, root: Column) -> None:
    """JSON lines in a folder for each root, by its safe name."""
    df.withColumn("root_safe", safe_name(root)).write.partitionBy("root_safe").json(path)


def write_split(df: DataFrame, path: str, flag: str = "is_train") -> None:
    """X.parquet as X_train.parquet and X_val.parquet."""
    stem = path.removesuffix(".parquet")
    df.where(F.col(flag)).drop(flag).write.parquet(f"{stem}_train.parquet")
    df.where(~F.col(flag)).drop(flag).write.parquet(f"{stem}_val.parquet")


def read_folder_of_records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All *.jsonl of a folder, with the stem of the file each came from."""
    found = spark.read.schema(schema).option("pathGlobFilter", "*.jsonl").option("mode", "FAILFAST").json(folder)
    return found.withColumn("stem", F.regexp_extract(F.input_file_name(), r"([^/]+)\.jsonl$", 1))


def write_object(df: DataFrame, path: str) -> None:
    """One row as one pretty JSON object, by the same file system as the tables."""
    text = df.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    text.limit(1).coalesce(1).write.text(path)


def write_by_stem(df: DataFrame, path: str, stem_col: str = "stem") -> None:
    """JSON lines in a folder <stem>_output.jsonl for each input file's stem, nulls kept."""
    named = df.withColumn("file", F.concat(F.col(stem_col), F.lit("_output.jsonl"))).drop(stem_col)
    named.write.partitionBy("file").option("ignoreNullFields", "false").json(path)
