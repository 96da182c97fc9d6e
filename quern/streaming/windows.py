"""Event-time windows, session windows and joins over streams with late data, all with state that the watermark bounds.

The watermark is the largest time seen in earlier batches less `delay`. What it has passed is closed: it is written once
and never changes, and rows that would belong to it are late and dropped. So the rows written are those of a batch query
over the rows that weren't late, restricted to what is closed.

Defined cases: rows with a null time or key belong to no window, session or pair; equal times and repeated rows count
each; empty portions change nothing; what the watermark hasn't passed at the end stays in the state, to be written when
later portions arrive.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(stream: DataFrame, time: str, size: str, by: list[str], aggregates: list[Column], delay: str, slide: str | None = None) -> DataFrame:
    """(window_start, window_end, by..., aggregates...) of tumbling windows, or of sliding ones that begin every `slide`.

    A window closes when the watermark reaches its end. Aggregates are partial before the shuffle, so a hot group is as
    many rows as there are tasks.
    """
    rows = stream.withWatermark(time, delay).where(F.col(time).isNotNull())
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    found = rows.groupBy(F.window(time, size, slide or size).alias("window"), *by).agg(*aggregates)
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in found.columns if c != "window"])


def merged(first: np.ndarray, last: np.ndarray, n: np.ndarray, total: np.ndarray, gap: int) -> tuple[np.ndarray, ...]:
    """Sessions, or parts of them, joined where less than `gap` lies between; in order of time."""
    order = np.argsort(first, kind="stable")
    first, last, n, total = first[order], last[order], n[order], total[order]
    new = np.ones(len(first), bool)
    new[1:] = first[1:] - np.maximum.accumulate(last)[:-1] >= gap
    at = np.flatnonzero(new)
    return first[at], np.maximum.reduceat(last, at), np.add.reduceat(n, at), np.add.reduceat(total, at)


def sessions(stream: DataFrame, time: str, by: str, value: str, gap_ms: int, delay: str) -> DataFrame:
    """(by, first, last, n, total) of each session: rows of a key with less than `gap_ms` from one to the next.

    Time is cut into panes of a gap's width. A task first merges its rows of one key and pane into one part, so a hot key
    sends as many rows as panes; a pane is late when the watermark, which follows the panes' ends, has reached its end. A
    session closes when a whole gap behind its last pane is late too, for then no part can reach it any more. The state
    of a key is its open sessions, as four arrays, and a timer for the first of them to close.
    """
    gap, key_type = gap_ms * 1000, stream.schema[by].dataType.simpleString()
    rows = stream.select(F.col(by).alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("at"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value")).where("key IS NOT NULL AND at IS NOT NULL")

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            groups = pdf.groupby(["key", pdf["at"] // gap], sort=False)
            out = groups.agg(first=("at", "min"), last=("at", "max"), n=("at", "size"), total=("value", "sum")).reset_index(names=["key", "pane"])
            out["pane_end"] = pd.to_datetime((out.pop("pane") + 1) * gap, unit="us", utc=True)
            yield out[["key", "pane_end", "first", "last", "n", "total"]]

    def follow(key: tuple, arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [[np.array(x, t)] for x, t in zip(state.get, ("i8", "i8", "i8", "f8"))] if state.exists else [[], [], [], []]
        if not state.hasTimedOut:
            for pdf in arrived:
                for x, c in zip(held, ("first", "last", "n", "total")):
                    x.append(pdf[c].to_numpy())
        first, last, n, total = merged(*(np.concatenate(x) for x in held), gap)
        closing = (last // gap + 2) * gap // 1000
        watermark = state.getCurrentWatermarkMs()
        done = closing <= watermark
        if done.all():
            state.remove()
        else:
            state.update(tuple(x[~done].tolist() for x in (first, last, n, total)))
            # A timer rings when the watermark is past it, not at it.
            state.setTimeoutTimestamp(int(closing[~done].min()) - 1)
        if done.any():
            moment = lambda x: pd.to_datetime(x[done], unit="us", utc=True)
            yield pd.DataFrame({by: [key[0]] * int(done.sum()), "first": moment(first), "last": moment(last), "n": n[done], "total": total[done]})

    made = rows.mapInPandas(parts, f"key {key_type}, pane_end timestamp, first long, last long, n long, total double").withWatermark("pane_end", delay)
    out, state = f"`{by}` {key_type}, first timestamp, last timestamp, n long, total double", "first array<long>, last array<long>, n array<long>, total array<double>"
    return made.groupBy("key").applyInPandasWithState(follow, out, state, "append", GroupStateTimeout.EventTimeTimeout)


def range_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, within_s: int, delay: str, how: str = "inner") -> DataFrame:
    """Pairs of rows that agree in `by` with right_time from left_time to within_s seconds later, as structs left and right.

    how: inner; or left, which also writes left rows without a partner, once none can come. A row stays in the state until
    the watermark (that of the slower stream) is past all it could meet. Inner joins also agree in bins of time, of which a
    left row lies in two, so a hot key's state is spread over as many places as it has bins.
    """
    one = left.withWatermark(left_time, delay).select(F.struct("*").alias("left"), F.col(left_time).alias("left_time"), *[F.col(b).alias(f"l{i}") for i, b in enumerate(by)])
    other = right.withWatermark(right_time, delay).select(F.struct("*").alias("right"), F.col(right_time).alias("right_time"), *[F.col(b).alias(f"r{i}") for i, b in enumerate(by)])
    reach = F.expr(f"left_time + INTERVAL {within_s} SECONDS")
    meet = (F.col("right_time") >= F.col("left_time")) & (F.col("right_time") <= reach)
    for i in range(len(by)):
        meet = meet & (F.col(f"l{i}") == F.col(f"r{i}"))
    if how == "inner":
        pane = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(within_s * 1_000_000))
        first = pane(F.col("left_time"))
        one = one.withColumn("l_pane", F.explode(F.array(first, first + 1)))
        other = other.withColumn("r_pane", pane(F.col("right_time")))
        meet = meet & (F.col("l_pane") == F.col("r_pane"))
    return one.join(other, meet, {"inner": "inner", "left": "leftOuter"}[how]).select("left", "right")
