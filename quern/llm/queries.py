"""The queries of this subpackage, with production parameters, and SQL for those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.ann import nearest
from quern.llm.langid import identify
from quern.llm import decontam, linededup, neardup, pivots, resample
from quern.llm.licenses import scan
from quern.llm.lm import score_texts
from quern.llm.packing import pack_documents
from quern.llm.piecebpe import encode_texts
from quern.llm.suffixdedup import cut_repeats
from quern.llm.tokencount import count_tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


def op2_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op3_mixture_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), folds=3, fold=1)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=1024)


def op5_content_defined_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "lines_report.*", F.sha2("text", 256).alias("kept_sha256"))


def op6_diagonal_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")


def op7_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)).drop("n_near")


def op8_odd_sketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).drop("text_hash")


def op9_interval_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cut_repeats(table(spark, sf_dir, "documents"), least=50)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


def op10_recurrent_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), folds=5, fold=1)


def op11_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.cluster_vectors(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64.0, seed="1").drop("n_checked")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, longest=2, buckets=10_000, least=20, seed="7")


def op13_prefix_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_cost_balanced_packing, op2_cross_polytope_neighbours, op3_mixture_language_id, op4_token_counts, op5_content_defined_line_dedup, op6_diagonal_license_scan, op7_positional_decontamination, op8_odd_sketch_near_duplicates, op9_interval_suffix_dedup, op10_recurrent_lm_scores, op11_ptolemaic_clusters, op12_importance_resampling, op13_prefix_table_pieces)}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_content_defined_line_dedup": linededup.sql(),
        "op7_positional_decontamination": decontam.sql(),
        "op8_odd_sketch_near_duplicates": neardup.sql(),
        "op11_ptolemaic_clusters": pivots.sql(),
        "op12_importance_resampling": resample.sql(),
    }
