"""As-of joins: every left row with the last right row at or before it.

Both tables are ranged and sorted together by key and time, and a task carries the last right row forward through its
range; a key of any size may lie in many ranges. Rows at a range's head whose match lies in an earlier range are left
pending. Every range then names the last right row of its last key, and the ranges' rows, one or two each, are carried
from range to range and joined with what is pending. There is one shuffle of both tables, and no window over a key.

Defined cases: null keys, times or kinds match nothing; such left rows stay, without a match. Of right rows with one key
and time the one with the largest `tie` counts (if those are equal, one chosen by hash). Repeated rows count each; empty
tables give no matches or no rows; names that both tables have don't clash, since the match is one struct column, for
which `name` should be a name that left doesn't have.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.scratch import small, stored

#: Places of a match that aren't rows of the batch: the last row carried, the last one carried of another kind, none.
LAST, OTHER, NONE = -1, -2, -3


class Carry:
    """What a range holds of its last key: the key, its last right row and the last one whose kind differs from that."""

    def __init__(self, kind: pa.DataType):
        empty = pa.nulls(1, kind)
        self.key, self.rows, self.kinds = None, {LAST: empty, OTHER: empty}, {LAST: None, OTHER: None}

    def follow(self, keys: list[pa.Array], right: np.ndarray, kinds: pa.Array, rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """For each row of a batch: its run of equal keys (0: the carried key), the places of its last right row and of the
        last one of another kind; a pool with these rows, the carried two at its end; and a number for every kind."""
        n = len(right)
        new = np.zeros(n, bool)
        for k in keys:
            new[1:] |= pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = self.key is None or self.key != [k[0].as_py() for k in keys]
        run, carried = np.cumsum(new), self.kinds[LAST] is not None
        code = pa.concat_arrays([kinds, pa.array([self.kinds[LAST]], kinds.type)]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(right)
        first = np.diff(run[at], prepend=-1) != 0
        before = np.concatenate([[LAST], at[:-1]]) if len(at) else at
        ours = first & (run[at] == 0) & carried  # follows the carried right row
        changes = (ours | ~first) & (code[at] != code[before])
        value = np.where(changes, before, np.where(ours, OTHER, NONE))
        marks = np.maximum.accumulate(np.where(first | changes, np.arange(len(at)), 0)) if len(at) else at
        second = value[marks]
        k = np.searchsorted(at, np.arange(n), "right") - 1
        here = (k >= 0) & (run[at[np.maximum(k, 0)]] == run) if len(at) else np.zeros(n, bool)
        outside = np.where((run == 0) & carried, 1, 0)
        last = np.where(here, at[np.maximum(k, 0)] if len(at) else NONE, np.where(outside, LAST, NONE))
        other = np.where(here, second[np.maximum(k, 0)] if len(at) else NONE, np.where(outside, OTHER, NONE))
        if self.kinds[OTHER] is None:
            other[other == OTHER] = NONE
        return run, last, other, pa.concat_arrays([rows, self.rows[OTHER], self.rows[LAST]]), code

    def keep(self, keys: list[pa.Array], last: int, other: int, kinds: pa.Array, pool: pa.Array) -> None:
        """Go on with the state behind the batch's last row."""
        name = lambda i: kinds[i].as_py() if i >= 0 else self.kinds[i] if i != NONE else None
        row = lambda i: pool.slice(i, 1) if i >= 0 else pool.slice(len(pool) + i, 1) if i != NONE else pa.nulls(1, pool.type)
        self.key = [k[-1].as_py() for k in keys]
        self.rows, self.kinds = {LAST: row(last), OTHER: row(other)}, {LAST: name(last), OTHER: name(other)}


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, *, exact: bool = True, differs: str | None = None, tie: str | None = None, within: float | None = None, name: str = "match", parts: int | None = None) -> DataFrame:
    """left with a struct column `name`: the last row of right with the same `by` whose time is not after left's.

    exact: rows of the same time match; otherwise only earlier ones. differs: a column of both tables in which the rows
    must differ. within: the largest distance, in seconds for timestamps. parts: ranges (spark.sql.shuffle.partitions).
    """
    spark = left.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = F.col(differs).cast("string") if differs else F.lit("")
    keys = [f"key{i}" for i in range(len(by))]

    def side(df: DataFrame, time: str, own: bool) -> DataFrame:
        return df.select(
            *[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(time).alias("time"), F.lit((0 if own else 1) if not exact else (1 if own else 0)).alias("side"),
            (F.lit(None) if own or not tie else F.col(tie)).cast(right.schema[tie].dataType if tie else "int").alias("tie"), kind.alias("kind"),
            F.struct("*").alias("row"),
        )

    l_rows, r_rows = side(left, left_time, True), side(right, right_time, False)
    usable = F.lit(True)
    for c in [*keys, "time", "kind"]:
        usable = usable & F.col(c).isNotNull()
    l_type, r_type = l_rows.schema["row"].dataType, r_rows.schema["row"].dataType
    both = l_rows.where(usable).select(*keys, "time", "side", "tie", "kind", F.col("row").alias("l"), F.lit(None).cast(r_type).alias("r"))
    both = both.unionByName(r_rows.where(usable).select(*keys, "time", "side", "tie", "kind", F.lit(None).cast(l_type).alias("l"), F.col("row").alias("r")))
    order = [*keys, "time", "side", "tie"]
    # Rows alike in all of this are told apart by hash, so that a crowded instant is spread and the order is always the same.
    ranged = both.withColumn("hash", F.xxhash64("kind", "l", "r")).repartitionByRange(parts, *order, "hash").sortWithinPartitions(*order, "hash")
    ranged = ranged.select(*keys, "kind", "l", "r", (F.col("side") == (0 if exact else 1)).alias("is_right"))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Left rows with their match in the range or pending; then the range's first and last key and its last right rows."""
        from pyspark import TaskContext

        part, state, head, runs = TaskContext.get().partitionId(), None, None, 0

        def rows(n: int, **columns) -> pa.RecordBatch:
            out = {f: columns.get(f, pa.nulls(n, types[f])) for f in types}
            out["part"] = pa.array([part] * n, pa.int32())
            return pa.RecordBatch.from_arrays(list(out.values()), list(out))

        for batch in batches:
            if not batch.num_rows:
                continue
            is_right, r, kinds = batch.column("is_right").to_numpy(zero_copy_only=False), batch.column("r"), batch.column("kind")
            key_columns = [batch.column(k) for k in keys]
            if state is None:
                state, head = Carry(r.type), [c[0].as_py() for c in key_columns]
                types = {"part": pa.int32(), "tag": pa.int32(), "pending": pa.bool_(), "kind": kinds.type, "l": batch.column("l").type, "r": r.type} | {k: c.type for k, c in zip(keys, key_columns)}
            run, last, other, pool, code = state.follow(key_columns, is_right, kinds, r)
            match = last
            if differs:
                same = (last != NONE) & (code[np.maximum(last, LAST)] == code[: len(last)])  # LAST, -1, is the code of the carried kind
                match = np.where(same, other, last)
            asking = np.flatnonzero(~is_right)
            found = match[asking]
            place = np.where(found >= 0, found, len(pool) + found)
            pending = (found == NONE) & (run[asking] + runs <= 1)
            matched = pool.take(pa.array(place, mask=found == NONE))
            if len(asking):
                at = pa.array(asking)
                yield rows(len(asking), pending=pa.array(pending), kind=kinds.take(at), l=batch.column("l").take(at), r=matched)
            state.keep(key_columns, int(last[-1]), int(other[-1]), kinds, pool)
            runs += int(run[-1])
        if state is not None:
            ends = {k: pa.array([a, b, None, None], types[k]) for k, a, b in zip(keys, head, state.key)}
            yield rows(4, tag=pa.array([0, 1, 2, 3], pa.int32()), kind=pa.array([None, None, state.kinds[OTHER], state.kinds[LAST]], types["kind"]), r=pa.concat_arrays([pa.nulls(2, types["r"]), state.rows[OTHER], state.rows[LAST]]), **ends)

    schema = ranged.select(F.lit(0).alias("part"), F.lit(0).alias("tag"), F.lit(True).alias("pending"), "kind", "l", "r", *keys).schema
    for field in schema.fields:
        field.nullable = True
    done = stored(ranged.mapInArrow(carry, schema))

    # Two keys and two kinds a range come to the driver; the rows they stand for stay where they are.
    ranges: dict[int, dict] = {}
    for t in done.where("tag IS NOT NULL").select("part", "tag", "kind", *keys).collect():
        ranges.setdefault(t["part"], {})[t["tag"]] = ([t[k] for k in keys], t["kind"])
    wanted, key, last, other = [], None, None, None
    for part in sorted(ranges):
        own = ranges[part]
        if own[0][0] == key:
            wanted += [(part, which, *at[:2]) for which, at in ((LAST, last), (OTHER, other)) if at]
        if own[1][0] != key or own[0][0] != key:
            key, last, other = own[1][0], None, None
        for tag in (2, 3):
            if (kind_of := own[tag][1]) is not None:
                if last and last[2] != kind_of:
                    other = last
                last = (part, tag, kind_of)
    pointers = spark.createDataFrame(wanted, "part int, which int, source int, tag int")
    sources = done.where("tag > 1").select(F.col("part").alias("source"), "tag", F.col("kind").alias("k"), "r").join(F.broadcast(pointers), ["source", "tag"])
    pick = lambda which, c, alias: F.first(F.when(F.col("which") == which, F.col(c)), ignorenulls=True).alias(alias)
    carried = stored(sources.groupBy("part").agg(pick(LAST, "r", "last_r"), pick(LAST, "k", "last_k"), pick(OTHER, "r", "other_r")))
    rows = done.where("tag IS NULL").join(small(carried), "part", "left")
    from_before = F.when((F.col("last_k") != F.col("kind")) | F.lit(differs is None), F.col("last_r")).otherwise(F.col("other_r"))
    rows = rows.select("l", F.coalesce("r", F.when(F.col("pending"), from_before)).alias("r"))
    rows = rows.unionByName(l_rows.where(~F.coalesce(usable, F.lit(False))).select(F.col("row").alias("l"), F.lit(None).cast(r_type).alias("r")))
    if within is not None:
        timed = left.schema[left_time].dataType.simpleString().startswith("timestamp")
        number = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6 if timed else F.col(c)
        rows = rows.withColumn("r", F.when(number(f"l.`{left_time}`") - number(f"r.`{right_time}`") <= within, F.col("r")))
    return rows.select("l.*", F.col("r").alias(name))
