"""Distinct counts and quantiles against brute force: hot values, ties, nulls, NaN, merges, few and no rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quern.operators import select, sketches

ROWS = "g string, h int, v double, w long"


def rows(seed=1, n=5000):
    """A third of the values is one value, another part two neighbours of the median's place."""
    rng = random.Random(seed)
    return [(rng.choice(["a"] * 5 + ["b", None]), rng.choice([1, 2, None]), rng.choice([50.0, rng.uniform(0, 100), rng.randint(0, 20) * 1.0, None, float("nan")]), rng.choice([7, rng.randint(0, 3000), None])) for _ in range(n)]


def test_distinct_counts_over_grouping_sets(spark):
    data, by, sets = rows(), ["g", "h"], [["g", "h"], ["g"], ["h"], []]
    df = spark.createDataFrame(data, ROWS).repartition(5)
    want = defaultdict(set)
    for g, h, _, w in data:
        for i, key in ((0, (g, h)), (1, (g, None)), (2, (None, h)), (3, (None, None))):
            want[(i, *key)] |= {w} - {None}
    got = {(r["set_id"], r["g"], r["h"]): r["n"] for r in sketches.distinct_counts(df, by, "w", sets).collect()}
    assert got == {k: len(v) for k, v in want.items()}
    halves = [sketches.distinct_sketches(df.where(F.col("w") % 2 == i), by, "w") for i in (0, 1)]
    halves.append(sketches.distinct_sketches(df.where("w IS NULL"), by, "w"))
    merged = sketches.distinct_estimates(halves[0].union(halves[1]).union(halves[2]), by, sets)
    found = {(r["set_id"], r["g"], r["h"]): r["estimate"] for r in merged.collect()}
    assert found.keys() == got.keys() and all(abs(found[k] - n) <= sketches.distinct_bound(12) * n for k, n in got.items())
    assert sketches.distinct_counts(df.limit(0), by, "w", sets).count() == 0


def model(data, keyed):
    groups = defaultdict(list)
    for g, _, v, _ in data:
        if v is not None and v == v and (g is not None or not keyed):
            groups[(g,) if keyed else ()].append(v)
    return {k: sorted(v) for k, v in groups.items()}


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("most", [100_000, 300, 1])
def test_order_statistics(spark, keyed, most):
    data, by = rows(3), ["g"] if keyed else []
    df = spark.createDataFrame(data, ROWS).repartition(5)
    ranks = {"first": "1", "p10": "(n + 9) div 10", "half": "(n + 1) div 2", "p99": "(n * 99 + 99) div 100", "last": "n"}
    got = {(*[r[c] for c in by], r["name"]): (r["n"], r["value"]) for r in sketches.order_statistics(df, "v", ranks, by, most, k=40).collect()}
    want = {}
    for key, values in model(data, keyed).items():
        n = len(values)
        want |= {(*key, name): (n, values[r - 1]) for name, r in {"first": 1, "p10": (n + 9) // 10, "half": (n + 1) // 2, "p99": (n * 99 + 99) // 100, "last": n}.items()}
    assert got == want


def test_two_values_only_and_no_rows(spark):
    df = spark.range(4001).selectExpr("IF(id < 2000, 5D, 7D) AS v", "1 AS g").union(spark.range(1500).selectExpr("5 + id / 1500D", "1"))
    ranked = {str(r): str(r) for r in (1, 2000, 2001, 2002, 3500, 3501, 5501)}
    values = sorted([5.0] * 2000 + [7.0] * 2001 + [5 + i / 1500 for i in range(1500)])
    got = sketches.order_statistics(df, "v", ranked, most=5, k=20).collect()
    assert {r["name"]: r["value"] for r in got} == {name: values[int(name) - 1] for name in ranked}
    assert sketches.order_statistics(df.limit(0), "v", ranked).count() == 0


def test_quantile_sketches_merge_within_their_bound(spark):
    data = rows(9, 20_000)
    df = spark.createDataFrame(data, ROWS).repartition(5)
    halves = [sketches.quantile_sketches(df.where(c), "v", ["g", "h"]) for c in ("w % 2 = 0", "w % 2 = 1 OR w IS NULL")]
    merged = sketches.merged_quantile_sketches(halves[0].union(halves[1]), ["g"])
    known = [r for r in data if r[1] is not None]
    for r in sketches.quantile_estimates(merged, ["g"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect():
        values = model(known, True)[(r["g"],)]
        least, upto = sum(v < r["estimate"] for v in values), sum(v <= r["estimate"] for v in values)
        off = 2 * sketches.rank_bound(400) * len(values)
        assert least - off <= r["share"] * len(values) <= upto + off


def test_score_statistics_are_exact_without_one_task(spark):
    df = spark.createDataFrame([(float(i % 90),) for i in range(1000)] + [(None,), (float("nan"),)], "s double")
    values = sorted(float(i % 90) for i in range(1000))
    got = select.score_stats(df, "s").first()
    assert (got["median"], got["min"], got["max"]) == ((values[499] + values[500]) / 2, 0.0, 89.0)
    assert tuple(select.score_stats(df.limit(0), "s").first()) == (None, None, None, None)
