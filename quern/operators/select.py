"""Score merging, filters, top-k and statistics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.html import fits_length, html_block, passes_rules, validation_status
from quern.functions.scores import CRITERION_WEIGHTS, passes_score
from quern.operators.sketches import exact_median


def merge_scores(rows: DataFrame, scores: DataFrame, key: str, score_col: str = "quality_score", details_col: str | None = None) -> DataFrame:
    """rows with their scores; a missing score is 0, missing details are `{}`."""
    filled = {score_col: F.coalesce(score_col, F.lit(0.0))} | ({details_col: F.coalesce(details_col, F.lit("{}"))} if details_col else {})
    return rows.join(scores, key, "left").withColumns(filled)


def top_k(rows: DataFrame, k: int | None, key: str, score_col: str | None = "quality_score") -> DataFrame:
    """The k best rows (ties: smaller key); the first k by key if there is no score; all if k is None or 0."""
    if not k:
        return rows
    order = [F.desc_nulls_last(score_col), F.asc(key)] if score_col in rows.columns else [F.asc(key)]
    return rows.orderBy(*order).limit(k)


def filter_chain(rows: DataFrame, key: str, response_col: str = "response", score_col: str = "quality_score", least: float = 80, most_tokens: int = 16384, target: int | None = None) -> DataFrame:
    """Rows that pass the rules, the length and (if there is such a column) the score; then the best `target` of them."""
    kept = rows.where(passes_rules(F.col(response_col))).where(fits_length(F.col(response_col), most_tokens))
    if score_col in rows.columns:
        kept = kept.where(passes_score(F.col(score_col), least))
    return top_k(kept, target, key, score_col)


def score_stats(rows: DataFrame, score_col: str, accuracy: int | None = None) -> DataFrame:
    """Mean, median, minimum and maximum of the scores that are numbers.

    The median is exact, from order statistics that no task holds all values for; with an accuracy it is approximate.
    """
    known = rows.where(F.col(score_col).isNotNull() & ~F.isnan(score_col))
    others = [F.avg(score_col).alias("mean"), F.min(score_col).alias("min"), F.max(score_col).alias("max")]
    if accuracy is not None:
        return known.agg(*others, F.percentile_approx(score_col, 0.5, accuracy).alias("median")).select("mean", "median", "min", "max")
    # One row each; on a key, since there is none to join by.
    found, one = known.agg(*others).withColumn("one", F.lit(1)), exact_median(known, score_col).withColumn("one", F.lit(1))
    return found.join(F.broadcast(one), "one", "left").select("mean", "median", "min", "max")


def status_counts(rows: DataFrame, status_col: str) -> DataFrame:
    """(status, n) of each status, and of all rows under `total`."""
    status = F.when(F.grouping(status_col) == 1, "total").otherwise(F.col(status_col))
    return rows.rollup(status_col).agg(status.alias("status_name"), F.count("*").alias("n")).select(F.col("status_name").alias("status"), "n")


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """(n_before, n_after, percent)."""
    counts = before.agg(F.count("*").alias("n_before")).crossJoin(after.agg(F.count("*").alias("n_after")))
    return counts.select("*", (F.col("n_after") * 100.0 / F.nullif(F.col("n_before"), F.lit(0))).alias("percent"))


def weighted_scores(scores: DataFrame, key: str, criterion_col: str = "criterion_id", score_col: str = "score") -> DataFrame:
    """(key, weighted, percent): criterion scores times their weights, and as a share of the most there could be."""
    weights = scores.sparkSession.createDataFrame([(i + 1, w) for i, w in enumerate(CRITERION_WEIGHTS)], f"{criterion_col} int, weight double")
    total = F.sum(F.col(score_col) * F.col("weight"))
    return scores.join(F.broadcast(weights), criterion_col).groupBy(key).agg(total.alias("weighted"), (total * 100 / (10 * sum(CRITERION_WEIGHTS))).alias("percent"))


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key has no result yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def truncated(text: str, most: int = 8000) -> Column:
    """The first `most` characters, as a judge's prompt takes them; null counts as empty."""
    return F.substring(F.coalesce(text, F.lit("")), 1, most)


def top_score(items: Column) -> Column:
    """The most points a checklist can give: the sum of its items' maxScore (5 where it is missing)."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda total, x: total + F.coalesce(x.maxScore, F.lit(5)).cast("long"))


def batch_summary(rows: DataFrame, score_col: str) -> DataFrame:
    """(mean, min, max) of a batch's rewards."""
    return rows.agg(F.avg(score_col).alias("mean"), F.min(score_col).alias("min"), F.max(score_col).alias("max"))


# The columns of a record that passed validation, besides the three that describe its page.
RECORD_COLUMNS = ["index", "question", "checklist", "source", "base_task_id", "base_task_title", "tech_stack", "design_style", "feature_modifier"]


def valid_records(rows: DataFrame, response_col: str = "response", success_col: str = "generation_success", columns: list[str] = RECORD_COLUMNS) -> DataFrame:
    """Records (columns, response, extraction_method, html_length) of successful generations with a valid page.

    response is the page alone; columns that the table lacks are null.
    """
    judged = rows.where(succeeded(rows, success_col)).withColumn("_block", html_block(F.col(response_col)))
    good = judged.where(F.col("_block.html").isNotNull() & (validation_status(F.col("_block.html")) == "valid"))
    own = [F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return good.select(*own, F.col("_block.html").alias("response"), F.col("_block.status").alias("extraction_method"), F.length("_block.html").cast("long").alias("html_length"))


def succeeded(rows: DataFrame, success_col: str = "generation_success") -> Column:
    """Whether a generation succeeded; null, or no such column, counts as failed."""
    return F.coalesce(F.col(success_col).cast("boolean"), F.lit(False)) if success_col in rows.columns else F.lit(False)


def record_counters(rows: DataFrame, response_col: str = "response", success_col: str = "generation_success", bad_col: str | None = None) -> DataFrame:
    """(counter, n): total, json_error, generation_failed, extract_<status>, valid_<status> and valid_total, if above 0.

    bad_col holds the text of lines that are no records; those count as json_error alone. One pass, one narrow shuffle.
    """
    bad = F.col(bad_col).isNotNull() if bad_col else F.lit(False)
    block = html_block(F.col(response_col))
    judged = rows.select(bad.alias("bad"), succeeded(rows, success_col).alias("ok"), block.status.alias("extracted"), F.when(block.html.isNotNull(), validation_status(block.html)).alias("status"))
    counters = (
        F.when(F.col("bad"), F.array(F.lit("json_error")))
        .when(~F.col("ok"), F.array(F.lit("total"), F.lit("generation_failed")))
        .otherwise(F.array_compact(F.array(F.lit("total"), F.concat(F.lit("extract_"), "extracted"), F.concat(F.lit("valid_"), "status"), F.when(F.col("status") == "valid", "valid_total"))))
    )
    return judged.select(F.explode(counters).alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))
