"""Distinct counts over grouping sets and quantiles: mergeable sketches with stated bounds, and exact forms that scale.

Sketches are made once, for the finest groups, and merged into all coarser ones; the finest table can be kept and merged
with that of later rows. Exact distinct counts first reduce rows to distinct ones, over which the grouping sets are few.
Exact order statistics use a quantile sketch to bracket a rank, count rows below, at and between the bracket's ends, and
go on inside, so that only a small share of the rows is looked at again and never more than `most` rows in one task.

Defined cases: null values, and NaN among numbers, are not counted; rows with a null group are a group of their own in
distinct counts and left out of quantiles, where groups meet by equality; repeated values count each in quantiles; empty
tables give no rows.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.scratch import small, stored

#: Shares at which a sketch is asked.
GRID = 500


def distinct_bound(precision: int) -> float:
    """Relative error of distinct counts that is exceeded in fewer than 3 of 1000 cases: three standard errors."""
    return 3 * 1.04 / 2 ** (precision / 2)


def rank_bound(k: int) -> float:
    """Error of a quantile sketch's ranks, as a share of the rows, that is exceeded in fewer than 1 of 100 cases."""
    return 2.296 / k**0.9723


def distinct_sketches(rows: DataFrame, by: list[str], of: str, precision: int = 12) -> DataFrame:
    """(by..., sketch): a mergeable sketch of the distinct values of `of` in each of the finest groups."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(of, precision).alias("sketch"))


def set_number(by: list[str]) -> Column:
    """Which of `by` a grouping set leaves out, as bits, the first column's the highest; 0 without any column."""
    return F.grouping_id().cast("long") if by else F.lit(0).cast("long")


def distinct_estimates(sketches: DataFrame, by: list[str], sets: list[list[str]]) -> DataFrame:
    """(set_id, by..., estimate) of every group of every grouping set, from sketches of finer groups."""
    merged = sketches.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(set_number(by).alias("set_id"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return merged.select("set_id", *by, F.coalesce("estimate", F.lit(0)).alias("estimate"))


def distinct_counts(rows: DataFrame, by: list[str], of: str, sets: list[list[str]]) -> DataFrame:
    """(set_id, by..., n): exact distinct values of `of`, by grouping set."""
    distinct = rows.select(*by, F.col(of).alias("of")).distinct()
    return distinct.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(set_number(by).alias("set_id"), F.count_distinct("of").alias("n")).select("set_id", *by, "n")


def numbers(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """(by..., v): the values that count, of groups without nulls."""
    v = F.col(column).cast("double")
    found = rows.select(*by, v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    for c in by:
        found = found.where(F.col(c).isNotNull())
    return found


def quantile_sketches(rows: DataFrame, column: str, by: list[str], k: int = 400) -> DataFrame:
    """(by..., sketch): a mergeable sketch of each group's values."""
    return numbers(rows, column, by).groupBy(*by).agg(F.kll_sketch_agg_double("v", k).alias("sketch"))


def merged_quantile_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of coarser groups, or of tables put together."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile_estimates(sketches: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """(by..., share, estimate): a value whose rank is within rank_bound(k) of the share."""
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(s)) for s in shares]))
    return sketches.select(*by, F.inline(F.arrays_zip(F.array(*[F.lit(float(s)) for s in shares]).alias("share"), values.alias("estimate"))))


def order_statistics(rows: DataFrame, column: str, ranks: dict[str, str], by: list[str] = [], most: int = 100_000, k: int = 400) -> DataFrame:
    """(by..., name, n, value): in each group of n values, the exact value of each rank, from 1.

    ranks: name -> rank as SQL over n, such as `ceil(n / 2)`.
    """
    keys, names = [*by, "one"], [*by, "one", "name"]
    left = numbers(rows, column, by).withColumn("one", F.lit(1))
    groups = left.groupBy(*keys).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch"))
    wanted = F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.expr(f"CAST({r} AS BIGINT)").alias("rank")) for name, r in ranks.items()]))
    targets = stored(groups.select(*keys, "n", F.col("n").alias("size"), "sketch", wanted))
    results = []
    while True:
        # Small groups are sorted, each in a task of its own, as large as `most` at most.
        few = targets.where(F.col("size") <= most).select(*names, "rank", "n")
        nth = F.row_number().over(Window.partitionBy(*names).orderBy("v"))
        inside = left.join(small(stored(few)), [c for c in names if c in left.columns])
        results.append(inside.withColumn("nth", nth).where(F.col("nth") == F.col("rank")).select(*names, "n", F.col("v").alias("value")))
        many = targets.where(F.col("size") > most)
        if many.isEmpty():
            break
        # A sketch answers for constant shares only: for a grid of them, of which the places around the rank are taken.
        grid = many.withColumn("grid", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])))
        at = lambda off: F.expr(f"get(grid, CAST(greatest(0, least({GRID}, round(({GRID}D * rank) / size) + {off})) AS INT))")
        wide = math.ceil(2 * rank_bound(k) * GRID) + 1
        brackets = small(stored(grid.select(*names, "n", "rank", at(-wide).alias("lo"), at(wide).alias("hi"))))
        met = left.join(brackets, [c for c in names if c in left.columns])
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        counts = met.groupBy(*names, "n", "rank", "lo", "hi").agg(*[F.count_if(x).alias(f"c{i}") for i, x in enumerate((v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & (hi > lo)))])
        upto = [sum((F.col(f"c{j}") for j in range(i)), F.lit(0)) for i in range(5)]
        place = F.when(F.col("rank") <= upto[1], 0).when(F.col("rank") <= upto[2], 1).when(F.col("rank") <= upto[3], 2).when(F.col("rank") <= upto[4], 3).otherwise(4)
        before = F.element_at(F.array(*upto), F.col("place") + 1)
        found = stored(counts.withColumn("place", place).withColumn("inner", F.col("rank") - before))
        results.append(found.where("place IN (1, 3)").select(*names, "n", F.when(F.col("place") == 1, lo).otherwise(hi).alias("value")))
        going = found.where("place IN (0, 2, 4)").select(*names, "n", F.col("inner").alias("rank"), "lo", "hi", "place")
        if going.isEmpty():
            break
        here = F.expr("CASE place WHEN 0 THEN v < lo WHEN 2 THEN v > lo AND v < hi ELSE v > hi END")
        left = stored(left.join(small(going), [c for c in names if c in left.columns]).where(here).select(*names, "v"))
        sizes = left.groupBy(*names).agg(F.count("*").alias("size"), F.kll_sketch_agg_double("v", k).alias("sketch"))
        targets = stored(sizes.join(going.select(*names, "n", "rank"), names))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select(*by, "name", "n", "value")


def exact_median(rows: DataFrame, column: str, by: list[str] = [], most: int = 100_000) -> DataFrame:
    """(by..., median): the middle value, or the mean of the two middle ones."""
    middle = order_statistics(rows, column, {"lower": "(n + 1) div 2", "upper": "n div 2 + 1"}, by, most)
    return middle.groupBy(*by).agg(F.avg("value").alias("median"))
