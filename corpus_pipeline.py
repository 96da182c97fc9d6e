"""The training-data pipeline over `documents`: identify, dedup lines, drop near copies, decontaminate, pack.

Every stage works on all rows its predecessor kept and returns the columns of `documents`; the last one returns pieces
of packed sequences. Between stages the rows are written and read again, so a lost executor repeats one stage at most.

Defined cases: a null text has no language, so its row goes in the first stage. Stages drop rows by doc_id and text, so
rows that share a doc_id but not the text are judged each by its own text, and rows that repeat both stay or go
together. Rows with a null doc_id are judged like others; as near copies they go only if a row with a doc_id is of
their group. n_chars, if there is such a column, follows the text; an empty table gives no pieces; columns beyond
doc_id, text and lang are passed on as they are.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.decontam import decontaminate
from quern.llm.langid import UNKNOWN, identify
from quern.llm.linededup import dedup_lines
from quern.llm.neardup import near_duplicates
from quern.llm.packing import pack_documents
from quern.scratch import stored, without

#: The EM mixture, the sketches and the tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows of gone (doc_id, text_hash)."""
    own = "row"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    hashed = docs.withColumn(f"{own}2", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))).withColumn(f"{own}1", F.col("doc_id").cast("long"))
    key = lambda df, name, text_hash: df.withColumns({f"{own}0": F.col(name).isNull(), f"{own}1": F.coalesce(name, F.lit(0)), f"{own}2": F.col(text_hash)})
    on = [f"{own}{i}" for i in range(3)]
    return without(key(hashed, f"{own}1", f"{own}2"), key(gone, "doc_id", "text_hash"), on).drop(*on)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which some learned language was found."""
    return identify(docs, rows=True).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that an earlier document has."""
    done = dedup_lines(docs).drop("lines_report")
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near-duplicates (five-word shingles, 0.8 or more)."""
    return without_rows(docs, near_duplicates(docs, words=5, percent=80).where("NOT kept AND component_id IS NOT NULL"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item (or a whole shorter item)."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_rows(docs, decontaminate(docs, items, size=10).where("n_hit > 0").select("doc_id", F.xxhash64("text").alias("text_hash")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
