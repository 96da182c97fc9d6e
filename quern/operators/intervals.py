"""Joins of two tables by overlapping ranges.

Two ranges overlap if one begins inside the other, so the join is two lookups of starts in ranges: starts of the right
table in ranges of the left one, and starts of the left table strictly inside ranges of the right one. Every pair is
found once, in one of them.

Ranges are indexed by level: a range's level is the width, a power of two, that it just fits, and at its level it
touches two bins at most, however long it is; long ranges thus lie apart, in few wide bins. A start is looked up once in
each level that occurs, 64 at most, so bins meet starts by equality and no inequality is left to a nested loop. At least
a third or so of what meets overlaps, where starts are spread evenly.

Bins with more than `chunk` ranges or starts are few. They are counted first, narrow and pre-aggregated; their ranges
and starts are cut into chunks, and every chunk of ranges meets every chunk of starts in a task of its own, so a crowded
bin is as parallel as its result is large.

Keys of which one table has a few ranges need no bins: their rows meet by key alone, and no table is written or copied
for them. Bins are for the other keys, for left joins and for joins without a key.

Defined cases: ranges are half open, or closed on request; null bounds or keys, and ranges without any point, overlap
nothing. Repeated rows are rows of their own; empty tables give no pairs; clashing names don't matter, since each side
is a struct column.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.scratch import small, stored


def whole(df: DataFrame, name: str) -> Column:
    """A bound as a long: microseconds of timestamps, days of dates, integers as they are."""
    kind = df.schema[name].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if kind == "date":
        return F.unix_date(name)
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{name} is {kind}: bounds are timestamps, dates or integers")
    return F.col(name).cast("long")


def indexed(df: DataFrame, bounds: tuple[str, str], by: list[str], closed: bool) -> DataFrame:
    """(id, key0..., start, stop, level, row) of the ranges that hold a point; stop is excluded. Written, so that ids stay."""
    start, stop = whole(df, bounds[0]).alias("start"), (whole(df, bounds[1]) + (1 if closed else 0)).alias("stop")
    rows = df.select(*[F.col(b).alias(f"key{i}") for i, b in enumerate(by)], start, stop, F.struct("*").alias("row"))
    for i in range(len(by)):
        rows = rows.where(F.col(f"key{i}").isNotNull())
    level = F.expr("CAST(IF(stop - start <= 1, 0, length(bin(stop - start - 1))) AS INT)")
    return stored(rows.where("start < stop").withColumns({"level": level, "id": F.monotonically_increasing_id()}))


def met(ranges: DataFrame, starts: DataFrame, keys: list[str], strictly: bool, chunk: int) -> DataFrame:
    """(range_id, start_id) of every start inside a range, strictly after its own start if asked for."""
    levels = sorted(r["level"] for r in ranges.select("level").distinct().collect())  # 64 at most
    on = [*keys, "level", "bin"]
    bins = F.expr("explode(IF(shiftright(start, level) = shiftright(stop - 1, level), array(shiftright(start, level)), array(shiftright(start, level), shiftright(stop - 1, level))))")
    left = ranges.select(*keys, "level", F.col("id").alias("range_id"), F.col("start").alias("a"), F.col("stop").alias("b"), bins.alias("bin"))
    right = starts.select(*keys, F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"), F.col("id").alias("start_id"), F.col("start").alias("at"))
    right = right.withColumn("bin", F.expr("shiftright(at, level)"))
    size = lambda df, name: df.groupBy(*on).agg(F.count("*").alias(name)).where(F.col(name) > chunk)
    crowded = size(left, "n").join(size(right, "m"), on, "full")
    parts = lambda name: F.ceil(F.coalesce(name, F.lit(1)) / chunk).cast("long").alias(name)
    crowded = small(stored(crowded.select(*on, parts("n"), parts("m"))))
    one, each = lambda name, n: F.pmod(name, F.coalesce(n, F.lit(1))), lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(n, F.lit(1)) - 1))
    left = left.join(crowded, on, "left").withColumn("i", one("range_id", "n")).withColumn("j", each("m")).drop("n", "m")
    right = right.join(crowded, on, "left").withColumn("j", one("start_id", "m")).withColumn("i", each("n")).drop("n", "m")
    inside = (F.col("at") > F.col("a") if strictly else F.col("at") >= F.col("a")) & (F.col("at") < F.col("b"))
    return left.join(right, [*on, "i", "j"]).where(inside).select("range_id", "start_id")


def crowded_keys(left: DataFrame, right: DataFrame, by: list[str], few: int, most: int) -> DataFrame:
    """(key0...): the keys that both tables have in more than `few` rows, or one of them in more than `most`; written."""
    count = lambda df, name: df.groupBy(*[F.col(c).alias(f"key{i}") for i, c in enumerate(by)]).agg(F.count("*").alias(name))
    both = count(left, "n").join(count(right, "m"), [f"key{i}" for i in range(len(by))])
    return stored(both.where((F.least("n", "m") > few) | (F.greatest("n", "m") > most)).drop("n", "m"))


def met_by_key(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], by: list[str], closed: bool, names: tuple[str, str]) -> DataFrame:
    """interval_join by equality of keys. Columns travel as they are; bounds are worked out where they are compared."""

    def side(df: DataFrame, bounds: tuple[str, str], name: str) -> tuple[DataFrame, Column, Column, Column, list[Column]]:
        place = lambda c: f"{name}{df.columns.index(c)}"
        rows = df.toDF(*map(place, df.columns))
        start, stop = whole(rows, place(bounds[0])), whole(rows, place(bounds[1])) + (1 if closed else 0)
        return rows.where(start < stop), start, stop, F.struct(*[F.col(place(c)).alias(c) for c in df.columns]), [F.col(place(c)) for c in by]

    one, a, b, row, keys = side(left, left_range, "l")
    other, c, d, other_row, other_keys = side(right, right_range, "r")
    on = (a < d) & (c < b)
    for x, y in zip(keys, other_keys):
        on = (x == y) & on
    return one.join(other, on).select(row.alias(names[0]), other_row.alias(names[1]))


def interval_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], by: list[str] = [], *, closed: bool = False, how: str = "inner", chunk: int = 2000, names: tuple[str, str] = ("left", "right"), few: int = 16, most: int = 100_000) -> DataFrame:
    """Pairs of rows, as two struct columns, whose ranges overlap and that agree in `by`.

    how: inner, or left, which keeps left rows without a partner. Both tables are joined back by row number, so only
    numbers and bounds are copied to bins. few, most: an inner join leaves to bins only the keys of more than `few` rows on
    both sides, or more than `most` on one.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how}")
    keys, plain = [f"key{i}" for i in range(len(by))], None
    if by and how == "inner":
        crowd = small(crowded_keys(left, right, by, few, most))
        if crowd.isEmpty():
            return met_by_key(left, right, left_range, right_range, by, closed, names)
        part = lambda df, kind: df.join(crowd.toDF(*by), by, kind).select(*[F.col(f"`{c}`") for c in df.columns])
        plain = met_by_key(part(left, "left_anti"), part(right, "left_anti"), left_range, right_range, by, closed, names)
        left, right = part(left, "left_semi"), part(right, "left_semi")
    one, other = indexed(left, left_range, by, closed), indexed(right, right_range, by, closed)
    pairs = met(one, other, keys, False, chunk).select(F.col("range_id").alias("l"), F.col("start_id").alias("r"))
    pairs = pairs.unionByName(met(other, one, keys, True, chunk).select(F.col("start_id").alias("l"), F.col("range_id").alias("r")))
    named = lambda df, i, name: df.select(F.col("id").alias(i), F.col("row").alias(name))
    if how == "inner":
        found = pairs.join(named(one, "l", names[0]), "l").join(named(other, "r", names[1]), "r").select(*names)
        return plain.unionByName(found) if plain is not None else found
    found = named(one, "l", names[0]).join(pairs, "l", "left").join(named(other, "r", names[1]), "r", "left").select(*names)
    usable = F.lit(True)
    for c in by:
        usable = usable & F.col(c).isNotNull()
    usable = F.coalesce(usable & (whole(left, left_range[0]) < whole(left, left_range[1]) + (1 if closed else 0)), F.lit(False))
    rest = left.where(~usable).select(F.struct("*").alias(names[0]), F.lit(None).cast(other.schema["row"].dataType).alias(names[1]))
    return found.unionByName(rest)
