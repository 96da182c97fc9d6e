"""As-of and interval joins against brute force: hot keys, ties, nulls, empty tables, clashing names, few and many ranges."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.operators.asof import asof_join
from quern.operators.intervals import interval_join

EVENTS = "id long, user string, at long, kind string, match int, l int, key0 int"


def events(seed=1, n=600):
    """A third of the rows belong to one user; times tie often."""
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot"] * 4 + ["a", "b", "c", None] * 2), rng.choice([None] + list(range(n // 6)) * 3), rng.choice(["x", "x", "x", "y", "z", None]), i, 2, 3) for i in range(n)]
    return rows + rows[:5]


def model_asof(left, right, exact, differs, within=None):
    out = []
    for l in left:  # noqa: E741
        best = None
        for r in right:
            if None in (l[1], l[2], r[1], r[2]) or l[1] != r[1] or r[2] > l[2] or (r[2] == l[2] and not exact):
                continue
            if differs and (None in (l[3], r[3]) or l[3] == r[3]):
                continue
            if best is None or (r[2], r[0]) > (best[2], best[0]):
                best = r
        if best and within is not None and l[2] - best[2] > within:
            best = None
        out.append((l, best))
    return Counter(out)


def joined(df):
    return Counter((tuple(r)[:-1], tuple(r[-1]) if r[-1] is not None else None) for r in df.collect())


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("differs", [None, "kind"])
@pytest.mark.parametrize("parts", [3, 40])
def test_asof_join(spark, exact, differs, parts):
    left, right = events(1), events(2, 300)
    l_df, r_df = (spark.createDataFrame(x, EVENTS).repartition(3) for x in (left, right))
    options = dict(exact=exact, differs=differs, tie="id", parts=parts)
    assert joined(asof_join(l_df, r_df, ["user"], "at", "at", **options)) == model_asof(left, right, exact, differs)
    assert joined(asof_join(l_df, r_df, ["user"], "at", "at", within=2, **options)) == model_asof(left, right, exact, differs, 2)


def test_asof_carries_over_many_ranges_and_batches(spark):
    """One user only: the match of nearly all rows lies ranges ahead; batches are smaller than runs of a kind."""
    right = [(i, "u", i, "x" if i < 3 else "y", 0, 0, 0) for i in range(5)]
    left = [(100 + i, "u", 10 + i % 500, "y" if i % 3 else "x", 0, 0, 0) for i in range(900)]
    l_df, r_df = spark.createDataFrame(left, EVENTS), spark.createDataFrame(right, EVENTS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = joined(asof_join(l_df, r_df, ["user"], "at", "at", differs="kind", tie="id", parts=25))
        both = joined(asof_join(l_df, l_df, ["user"], "at", "at", differs="kind", tie="id", exact=False, parts=9))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == model_asof(left, right, True, "kind") and {r[1][0] for r in got} == {2, 4}
    assert both == model_asof(left, left, False, "kind")


def test_asof_without_rows_keys_and_with_timestamps(spark):
    df = spark.createDataFrame(events(3, 60), EVENTS)
    none = df.limit(0)
    assert joined(asof_join(df, none, ["user"], "at", "at")) == Counter((r, None) for r in events(3, 60))
    assert asof_join(none, df, ["user"], "at", "at").count() == 0
    every = [(i, "", t, k, m, a, b) for i, _, t, k, m, a, b in events(3, 60)]
    plain = spark.createDataFrame(every, EVENTS)
    assert joined(asof_join(plain, plain, [], "at", "at", tie="id", parts=4)) == model_asof(every, every, True, None)
    timed = df.withColumn("at", F.timestamp_micros(F.col("at") * 1_500_000))
    got = asof_join(timed, timed, ["user"], "at", "at", exact=False, tie="id", within=3.0, name="m").select("id", "m.id").collect()
    assert Counter(map(tuple, got)) == Counter({(a[0], b and b[0]): n for (a, b), n in model_asof(events(3, 60), events(3, 60), False, None, 2).items()})


RANGES = "id long, k string, a long, b long, row int, level int, start string"


def ranges(seed, n, longest):
    """Many short ranges, some long ones, a third of them in one place."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.choice([5000, rng.randint(-10_000, 10_000)])
        rows.append((i, rng.choice(["p", "p", "q", None]), a, a + rng.choice([0, -3, 1, 2, 7, rng.randint(1, longest)]), i, 1, "s"))
    return rows + [rows[1], rows[1], (n, "p", None, 4, 0, 0, "s"), (n + 1, "p", 4, None, 0, 0, "s"), (n + 2, "p", -(2**40), 2**40, 0, 0, "s")]


def model_intervals(left, right, keyed, closed):
    end = 1 if closed else 0
    fine = lambda r: None not in r[2:4] and r[2] < r[3] + end and not (keyed and r[1] is None)
    return Counter((l, r) for l in left for r in right if fine(l) and fine(r) and l[2] < r[3] + end and r[2] < l[3] + end and (not keyed or l[1] == r[1]))  # noqa: E741


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("closed, chunk", [(False, 2000), (True, 7)])
def test_interval_join(spark, keyed, closed, chunk):
    left, right = ranges(1, 150, 40), ranges(2, 200, 3000)
    l_df, r_df = (spark.createDataFrame(x, RANGES).repartition(3) for x in (left, right))
    pairs = lambda df: Counter(tuple(tuple(x) if x else None for x in r) for r in df.collect())
    want, by = model_intervals(left, right, keyed, closed), ["k"] if keyed else []
    assert pairs(interval_join(l_df, r_df, ("a", "b"), ("a", "b"), by, closed=closed, chunk=chunk)) == want
    alone = Counter(left) - Counter({x: left.count(x) for x in {a for a, _ in want}})
    assert pairs(interval_join(l_df, r_df, ("a", "b"), ("a", "b"), by, closed=closed, chunk=chunk, how="left")) == want + Counter({(x, None): n for x, n in alone.items()})


@pytest.mark.parametrize("few, most", [(16, 100_000), (0, 100_000), (1000, 1000), (1000, 3)])
def test_interval_join_by_key_and_by_bins(spark, few, most):
    left, right = ranges(3, 120, 40), ranges(4, 160, 3000)
    l_df, r_df = (spark.createDataFrame(x, RANGES).repartition(3) for x in (left, right))
    got = interval_join(l_df, r_df, ("a", "b"), ("a", "b"), ["k"], few=few, most=most)
    assert Counter(tuple(tuple(x) for x in r) for r in got.collect()) == model_intervals(left, right, True, False)


def test_rows_of_few_ranges_a_key_are_not_copied(spark):
    """One range a key and 20 starts: a start travels once, and not once for each width that some range has."""
    left = spark.range(200).selectExpr("id AS k", "0L AS a", "shiftleft(1L, CAST(id % 30 AS INT)) AS b")
    right = spark.range(4000).selectExpr("id % 200 AS k", "id AS a", "id + 1 AS b", "id AS v")
    sc = spark.sparkContext

    def moved():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = moved()
    got = interval_join(left, right, ("a", "b"), ("a", "b"), ["k"]).groupBy("left.k").agg(F.count("*").alias("n")).collect()
    assert {r["k"]: r["n"] for r in got} == {k: n for k in range(200) if (n := sum(a < 2 ** (k % 30) for a in range(k, 4000, 200)))}
    assert moved() - before < 3 * 4200


def test_interval_join_of_dates_and_empty_tables(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    df = spark.createDataFrame([(i, day(i), day(i + i % 4)) for i in range(30)], "id long, a date, b date")
    got = interval_join(df, df, ("a", "b"), ("a", "b"), closed=True).select("left.id", "right.id").collect()
    assert Counter(map(tuple, got)) == Counter((i, j) for i in range(30) for j in range(30) if i <= j + j % 4 and j <= i + i % 4)
    assert interval_join(df, df.limit(0), ("a", "b"), ("a", "b")).count() == 0
    assert interval_join(df, df.limit(0), ("a", "b"), ("a", "b"), how="left").count() == 30
    with pytest.raises(ValueError):
        interval_join(df.withColumn("a", F.lit("x")), df, ("a", "b"), ("a", "b"))


def test_crowded_bins_are_cut(spark):
    """3,000 equal ranges against 3,000 starts within them: all pairs, and no task gets them all."""
    df = spark.range(3000).selectExpr("id", "0L AS a", "10L AS b")
    got = interval_join(df, df, ("a", "b"), ("a", "b"), chunk=500)
    assert got.count() == 9_000_000
