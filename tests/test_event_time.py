"""Windows, sessions and joins over arriving portions against a model of the watermark: late rows, ties, nulls, a hot key."""

import random
import uuid
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quern.streaming.arrivals import feed
from quern.streaming.windows import range_join, sessions, windowed

MINUTE = 60_000_000
DELAY = 40


def portions(seed=1, n=400, count=4):
    """Rows (id, user, at in microseconds, value), a third of one user's, some in a later portion than their time's."""
    rng = random.Random(seed)
    out = [[] for _ in range(count)]
    for i in range(n):
        at = i * MINUTE // 2 + rng.choice([0, 0, 1, 999_999, MINUTE])
        user, late = rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice([0] * 8 + [1, 2])
        out[min(count - 1, i * count // n + late)].append((i, user, None if i % 50 == 7 else at, float(i % 9)))
    out[1] += out[0][:3] + out[1][:4]
    return out


def watermarks(values, delay=DELAY):
    """The watermark, in microseconds, before every portion and after the last; milliseconds are cut off."""
    out, top = [0], None
    for v in values:
        top = max([x for x in [top, *v] if x is not None], default=None)
        out.append(0 if top is None else max(0, (top // 1000 - delay * 60_000) * 1000))
    return out


def frames(spark, parts):
    schema = "id long, user string, us long, value double"
    return [spark.createDataFrame(p, schema).withColumn("at", F.timestamp_micros("us")).repartition(3) for p in parts]


def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


micros = lambda t: round(t.timestamp() * 1e6)


@pytest.mark.parametrize("size, slide", [(10, 10), (30, 10)])
def test_windows_drop_late_rows_and_write_what_is_closed(spark, tmp_path, size, slide):
    parts = portions()
    marks = watermarks([[r[2] for r in p] for p in parts])
    want, late = defaultdict(list), 0
    for before, p in zip(marks, parts):
        for i, user, at, value in p:
            for k in range(size // slide) if at is not None and user else []:
                start = (at // (slide * MINUTE) - k) * slide * MINUTE
                late += start + size * MINUTE <= before
                if start + size * MINUTE > before:
                    want[start, user].append(value)
    assert late > 5
    build = lambda s: windowed(s, "at", f"{size} minutes", ["user"], [F.count("*").alias("n"), F.sum("value").alias("total")], f"{DELAY} minutes", f"{slide} minutes")
    got = feed(frames(spark, parts), build, folder(tmp_path)).collect()
    closed = {k: v for k, v in want.items() if k[0] + size * MINUTE <= marks[-1]}
    assert {(micros(r["window_start"]), r["user"]): (r["n"], r["total"]) for r in got} == {k: (len(v), sum(v)) for k, v in closed.items()} and len(got) == len(closed)
    assert all(micros(r["window_end"]) - micros(r["window_start"]) == size * MINUTE for r in got)


def model_sessions(parts, gap):
    pane_end = lambda at: (at // gap + 1) * gap
    marks = watermarks([[pane_end(r[2]) for r in p if r[1] and r[2] is not None] for p in parts])
    kept, late = defaultdict(list), 0
    for before, p in zip(marks, parts):
        for _, user, at, value in p:
            if user and at is not None:
                late += pane_end(at) <= before
                if pane_end(at) > before:
                    kept[user].append((at, value))
    out = []
    for user, rows in kept.items():
        rows.sort()
        for i, (at, value) in enumerate(rows):
            if i and at - rows[i - 1][0] < gap:
                out[-1] = (user, out[-1][1], at, out[-1][3] + 1, out[-1][4] + value)
            else:
                out.append((user, at, at, 1, value))
    return Counter(s for s in out if pane_end(s[2]) + gap <= marks[-1]), late


@pytest.mark.parametrize("gap", [60_000, 180_000])
def test_sessions_close_by_timer_and_outlive_restarts(spark, tmp_path, gap):
    parts = portions(5)
    parts.append([(1000, "c", 900 * MINUTE, 0.0)])  # no row of the other keys: their timers close them
    want, late = model_sessions(parts, gap * 1000)
    got = feed(frames(spark, parts), lambda s: sessions(s, "at", "user", "value", gap, f"{DELAY} minutes"), folder(tmp_path)).collect()
    assert Counter((r["user"], micros(r["first"]), micros(r["last"]), r["n"], r["total"]) for r in got) == want
    assert late > 5 and {s[0] for s in want} == {"hot", "a", "b", "c"}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join_of_streams(spark, tmp_path, how):
    parts = portions(9)
    sides = lambda p: ([r for r in p if r[0] % 3 == 0], [r for r in p if r[0] % 3])
    marks = [min(m) for m in zip(*(watermarks([[r[2] for r in sides(p)[s]] for p in parts]) for s in (0, 1)))]
    kept = [[r for before, p in zip(marks, parts) for r in sides(p)[s] if r[2] is not None and r[2] > before] for s in (0, 1)]
    pairs = Counter((l, r) for l in kept[0] for r in kept[1] if l[1] and l[1] == r[1] and 0 <= r[2] - l[2] <= 5 * MINUTE)  # noqa: E741
    assert sum(map(len, kept)) < sum(map(len, parts)) - 20 and len(pairs) > 50
    build = lambda s: range_join(s.where("id % 3 = 0"), s.where("id % 3 > 0"), ["user"], "at", "at", 300, f"{DELAY} minutes", how)
    got = Counter((tuple(r["left"])[:4], r["right"] and tuple(r["right"])[:4]) for r in feed(frames(spark, parts), build, folder(tmp_path)).collect())
    assert Counter({k: n for k, n in got.items() if k[1]}) == pairs
    alone = Counter({k[0]: n for k, n in got.items() if not k[1]})
    if how == "left":
        want = Counter(l for l in kept[0] if l not in {a for a, _ in pairs} and (not l[1] or l[2] + 5 * MINUTE < marks[-1]))  # noqa: E741
        assert {l for l in want if l[1]} == {l for l in alone if l[1]}  # noqa: E741
    else:
        assert not alone


def test_empty_portions(spark, tmp_path):
    parts = [[], portions()[0], []]
    for build in (
        lambda s: windowed(s, "at", "10 minutes", ["user"], [F.count("*").alias("n")], "0 minutes"),
        lambda s: sessions(s, "at", "user", "value", 60_000, "0 minutes"),
        lambda s: range_join(s, s, ["user"], "at", "at", 60, "0 minutes"),
    ):
        assert feed(frames(spark, parts), build, folder(tmp_path)).count() > 0
    assert feed(frames(spark, [[]]), build, folder(tmp_path)).count() == 0
