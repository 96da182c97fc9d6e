"""Approximate nearest neighbours by cross-polytope hashing with exact reranking.

Vectors are scaled to unit length and turned by fast pseudo-rotations (three rounds of random signs and a Hadamard
transform). A rotation assigns a vector to the nearest signed axis; a table joins the axes of one rotation or more, the
last one's among a part of its axes, so that the codes grow with the table and hold about PER_CODE vectors at any size.
A query probes, in every table, the codes with the largest sums of its own coordinates. Every code's vectors are scored
exactly, by inner products of the original vectors in double precision, and each query keeps its nearest.

How many codes are probed is measured: for a sample of SAMPLE queries, chosen by hash, the true nearest vectors are
found by one pass over the table, and enough codes are probed for SHARE of them to lie in a probed code of some table.

Codes are dealt in ranges of about `block` vectors. A range receives each query that probes any of its codes once, with
the list of those codes; ranges that hold too many vectors (unlike vectors with one code) are split further. Queries go
to the range of their best code in every table first. What they find there bounds the score of their k nearest from
below, so the other ranges give only pairs that reach it, not the k nearest of each range.

Inner products of vectors of unequal length become angles by one more coordinate: sqrt(longest^2 - length^2) for the
indexed vectors, 0 for the queries. Vectors are indexed by bands of length, each with its own `longest` and its own codes,
so that a few long vectors don't turn all others towards that coordinate; a query probes every band. Queries that find
fewer than k others this way, and fewer than there are, are scored exactly against all vectors, in blocks. Equal vectors
are one node: it is hashed and scored once, and lists the smallest of its ids, as many as could be returned, since ties
go to smaller ids.

Defined cases: vectors that are null, of another length than most, zero, or that hold null or non-finite components
take no part; so do null ids. Repeated rows are one row. With fewer than k others all are returned; a query without
any other row has no row; empty tables give no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.scratch import small, stored

#: Vectors that a code holds on average, queries whose true neighbours are measured, and the share of these to be probed.
PER_CODE, SAMPLE, SHARE = 4, 64, 0.95


def rotations(dims: int, tables: int, axes: int, seed: int = 11) -> np.ndarray:
    """Random signs (table x axis of a code x round x padded dimension)."""
    padded = 1 << max(1, dims - 1).bit_length()
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, axes, 3, padded))


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows of x under one pseudo-rotation: (Hadamard, signs) three times."""
    rounds, n = signs.shape
    y = np.zeros((len(x), n))
    y[:, : x.shape[1]] = x
    for r in range(rounds):
        y = y * signs[r]
        half = 1
        while half < n:
            y = y.reshape(len(x), -1, 2, half)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
            half *= 2
        y /= np.sqrt(n)
    return y


def widths(rows: int, padded: int) -> list[int]:
    """How many coordinates of each rotation take part in a code: all of them, of the last rotation as many as the rows allow."""
    out, wanted = [], rows / PER_CODE
    while not out or wanted >= 2:
        out.append(min(padded, 1 << max(0, int(wanted / 2).bit_length() - 1)))
        wanted /= 2 * out[-1]
    return out


def signed(y: np.ndarray, width: int) -> np.ndarray:
    """The coordinates of both signs: 2 * axis, and 2 * axis + 1 for the negative one."""
    return np.stack([y[:, :width], -y[:, :width]], 2).reshape(len(y), -1)


def codes_of(x: np.ndarray, signs: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Each row's code: the nearest signed axis of every rotation, joined."""
    code = np.zeros(len(x), np.int64)
    for turn, width in zip(signs, sizes):
        code = code * 2 * width + signed(rotated(x, turn), width).argmax(1)
    return code


def probed_codes(x: np.ndarray, signs: np.ndarray, sizes: list[int], probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The `probes` codes with the largest sums of coordinates of each row (all, if there are fewer), in order of codes,
    and each row's best code.

    Axes are added one by one: the first axes of a best code are always among the best so far.
    """
    code, total = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for turn, width in zip(signs, sizes):
        both = signed(rotated(x, turn), width)
        total = (total[:, :, None] + both[:, None, :]).reshape(len(x), -1)
        code = (code[:, :, None] * 2 * width + np.arange(2 * width)).reshape(len(x), -1)
        if total.shape[1] > probes:
            top = np.argpartition(-total, probes - 1, axis=1)[:, :probes]
            total, code = np.take_along_axis(total, top, 1), np.take_along_axis(code, top, 1)
    return np.sort(code, axis=1), np.take_along_axis(code, total.argmax(1)[:, None], 1)[:, 0]


def code_ranks(q: np.ndarray, x: np.ndarray, signs: np.ndarray, sizes: list[int]) -> np.ndarray:
    """For each pair of rows of q and x, how many codes come before x's code in the order in which q probes."""
    step, out = max(1, (4 << 20) // int(np.prod([2 * w for w in sizes[::2]]))), []
    for a in range(0, len(q), step):
        # Sums over every other rotation, and over those between; a code's sum is one of each, so codes aren't listed.
        parts, own = [np.zeros((len(q[a : a + step]), 1))] * 2, np.zeros(len(q[a : a + step]))
        for i, (turn, width) in enumerate(zip(signs, sizes)):
            both = signed(rotated(q[a : a + step], turn), width)
            own += both[np.arange(len(own)), signed(rotated(x[a : a + step], turn), width).argmax(1)]
            parts[i % 2] = (parts[i % 2][:, :, None] + both[:, None, :]).reshape(len(own), -1)
        out += [int(np.sum(len(t) - np.searchsorted(np.sort(t), o + 1e-12 - h, "right"))) for h, t, o in zip(*parts, own)]
    return np.array(out)


def probes_needed(pairs: list[tuple], signs: np.ndarray, sizes: dict[int, list[int]]) -> dict[int, int]:
    """How many codes of each band to probe, from pairs (band, query, neighbour) of scaled vectors.

    Of every pair the best table counts. Bands with few pairs take the largest share of codes that any other band takes.
    """
    codes = {band: int(np.prod([2 * w for w in own])) for band, own in sizes.items()}
    needed: dict[int, float] = {}
    for band in {p[0] for p in pairs}:
        own = [p for p in pairs if p[0] == band]
        q, x = (np.array([p[i] for p in own]) for i in (1, 2))
        best = np.min([code_ranks(q, x, turn, sizes[band]) for turn in signs], axis=0)
        if len(own) >= 40 or len(own) * 2 > len(pairs):
            needed[band] = float(np.quantile(best, SHARE, method="higher")) + 1
    most = max((n / codes[band] for band, n in needed.items()), default=1.0)
    return {band: int(min(n, max(1, np.ceil(needed.get(band, most * n))))) for band, n in codes.items()}


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, v) of the rows that take part; v holds doubles."""
    v = F.col(column).cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(fine & F.col("id").isNotNull())
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0)).distinct()


def best_pairs(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (i of q, j of x), the k nearest of each i and those as near but for rounding, with their exact scores."""
    order = np.lexsort((-rough, i))
    i, j, rough = i[order], j[order], rough[order]
    start = np.flatnonzero(np.diff(i, prepend=-1))
    size = np.diff(np.append(start, len(i)))
    floor = np.repeat(rough[start + np.minimum(size, k) - 1], size)
    near = rough >= floor - 1e-9 * (1 + np.abs(floor))
    i, j = i[near], j[near]
    return i, j, (q[i] * x[j]).sum(1)


def scaled(rows: pd.DataFrame) -> np.ndarray:
    """Vectors by their band's longest, with the coordinate that makes them unit vectors."""
    top = np.maximum(rows.top.to_numpy(), np.finfo(float).tiny)[:, None]
    x = np.array(rows.v.tolist(), np.float64) / top
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (rows.length.to_numpy()[:, None] / top) ** 2))], 1)


def neighbours_of_sample(ranged: DataFrame, asked: DataFrame, k: int) -> list[tuple]:
    """(band, query, neighbour), scaled, of the true k nearest of SAMPLE queries: one pass over all vectors."""
    chosen = asked.select("node").distinct().orderBy(F.xxhash64("node"), "node").limit(SAMPLE)
    sample = ranged.join(F.broadcast(chosen), "node").select("node", "v", "length").toPandas()
    if not len(sample):
        return []
    q = np.array(sample.v.tolist(), np.float64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 5000):
                some = pdf.iloc[a : a + 5000]
                score = np.array(some.v.tolist(), np.float64) @ q.T
                score[some.node.to_numpy()[:, None] == sample.node.to_numpy()] = -np.inf
                at, of = np.nonzero(score >= np.partition(score, -min(k, len(some)), axis=0)[-min(k, len(some))])
                out = some.iloc[at].drop(columns="node")
                out["query"], out["score"] = of, score[at, of]
                yield out[out.score > -np.inf]

    near = ranged.select("node", "band", "v", "length", "top").mapInPandas(run, "band long, v array<double>, length double, top double, query long, score double")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "band"))
    near = near.withColumn("nth", nth).where(F.col("nth") <= k).drop("nth").toPandas()  # k a sampled query
    if not len(near):
        return []
    asking = np.concatenate([q / sample.length.to_numpy()[:, None], np.zeros((len(q), 1))], 1)
    return list(zip(near.band, asking[near["query"].to_numpy()], scaled(near)))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, tables: int = 6, block: int = 2000, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by `every`."""
    rows = usable(vectors, id_column, column)
    single = "array<float>" in vectors.schema[column].dataType.simpleString()
    kind = np.float32 if single else np.float64  # what loses nothing
    # Of equal vectors, the smallest k + 1 ids (one may be the query's own) can be returned, and every query asks.
    nodes = stored(
        rows.groupBy("v")
        .agg(F.min("id").alias("node"), F.count("*").alias("n"))
        .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    )
    members = rows.join(nodes.select("v", "node"), "v").select("node", "id")
    shape = nodes.agg(F.max(F.size("v")).alias("dims"), F.max("length").alias("longest")).first()
    dims, longest = shape["dims"] or 1, shape["longest"] or 1.0
    padded = 1 << max(1, dims).bit_length()
    asked = stored(members.where(F.col("id") % every == 0))
    # Lengths of a band differ by a factor of 2 ** (1 / 4) at most; those too small for a double are a band of their own.
    # There are at most about 8200 bands, so their table is small whatever the input.
    shorter = F.nanvl(F.log2(F.lit(longest)) - F.log2("length"), F.lit(0.0))
    banded = nodes.withColumn("band", F.coalesce(F.floor(shorter * 4), F.lit(1 << 14)))
    tops = stored(banded.groupBy("band").agg(F.max("length").alias("top"), F.count("*").alias("rows")))
    rows_of = {r["band"]: r["rows"] for r in tops.collect()}
    sizes = {band: widths(n, padded) for band, n in rows_of.items()}
    n_codes = {band: int(np.prod([2 * w for w in own])) for band, own in sizes.items()}
    # A range of codes holds about `block` vectors of its band if they are spread evenly.
    per_range = {band: -(-n_codes[band] // min(n_codes[band], -(-n // block))) for band, n in rows_of.items()}
    signs = rotations(dims + 1, tables, max(map(len, sizes.values()), default=1))
    probes = probes_needed(neighbours_of_sample(banded.join(F.broadcast(tops), "band"), asked, k), signs, sizes)

    def raw(x: np.ndarray) -> list[bytes]:
        return [r.tobytes() for r in x.astype(kind)]

    def unraw(column: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 2000):
                for band, some in pdf.iloc[a : a + 2000].groupby("band"):
                    own, v, codes = scaled(some), raw(np.array(some.v.tolist(), np.float64)), n_codes[band]
                    for t in range(tables):
                        code = codes_of(own, signs[t], sizes[band])
                        yield pd.DataFrame({"band": band, "range": t * codes + code // per_range[band], "node": some.node.to_numpy(), "code": code, "v": v})

    def ask(first: bool):
        """The ranges that a query probes: those of its best codes, or all others."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            most = max(min(probes[band] * 2 * own[-1], n_codes[band]) for band, own in sizes.items())
            step = max(1, (8 << 20) // (most + 4 * padded * padded))
            for pdf in batches:
                for a in range(0, len(pdf), step):
                    some = pdf.iloc[a : a + step]
                    x = np.array(some.v.tolist(), np.float64)
                    own = np.concatenate([x / some.length.to_numpy()[:, None], np.zeros((len(x), 1))], 1)
                    v, out = raw(x), []
                    for t in range(tables):
                        for band, own_sizes in sizes.items():
                            codes, best = probed_codes(own, signs[t], own_sizes, probes[band])
                            per, first_range = per_range[band], t * n_codes[band]
                            for node, bytes_, least, own_codes, top in zip(some.node, v, some.least, codes, best // per):
                                which = own_codes // per
                                cuts = np.flatnonzero(np.diff(which, prepend=-1))
                                out += [(band, first_range + int(which[c]), node, part.tobytes(), bytes_, least) for c, part in zip(cuts, np.split(own_codes, cuts[1:])) if (which[c] == top) == first]
                    yield pd.DataFrame(out, columns=["band", "range", "node", "codes", "v", "least"])

        return run

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"band": pdf.band, "node": pdf.node, "v": raw(np.array(pdf.v.tolist(), np.float64).reshape(len(pdf), -1))})

    def result(queries: pd.DataFrame, held: pd.DataFrame, found: list[tuple]) -> pd.DataFrame:
        i, j, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"query": queries.node.to_numpy(np.int64)[i], "node": held.node.to_numpy(np.int64)[j], "score": score})

    def score_codes(key: tuple, queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """Pairs of a query and the vectors of the codes it probes."""
        if not len(queries) or not len(held):
            return result(queries, held, [])
        held = held.sort_values(["code", "node"], ignore_index=True)
        x, code = unraw(held.v), held.code.to_numpy()
        names, start = np.unique(code, return_index=True)
        stop, found = np.append(start[1:], len(code)), []
        for a in range(0, len(queries), 1000):
            some = queries.iloc[a : a + 1000]
            q, lists, least = unraw(some.v), [np.frombuffer(c, np.int64) for c in some.codes], some.least.to_numpy()
            least = least - 1e-9 * (1 + np.abs(least))
            which, who = np.concatenate(lists), np.repeat(np.arange(len(some)), [len(c) for c in lists])
            at = np.searchsorted(names, which)
            there = names[np.minimum(at, len(names) - 1)] == which
            at, who = at[there], who[there]
            order = np.argsort(at, kind="stable")
            at, who = at[order], who[order]
            cuts, pairs, held_pairs = np.flatnonzero(np.diff(at, prepend=-1)), [], 0
            for b, e in zip(cuts, np.append(cuts[1:], len(at))):
                lo, hi, own = start[at[b]], stop[at[b]], who[b:e]
                for c in range(lo, hi, block):
                    rough = q[own] @ x[c : min(hi, c + block)].T
                    i, j = np.nonzero(rough >= least[own][:, None])
                    pairs.append((own[i], j + c, rough[i, j]))
                    held_pairs += len(i)
                    if held_pairs > 4_000_000:  # bounded: what can't be among the nearest is left behind
                        i, j, score = best_pairs(q, x, *(np.concatenate(p) for p in zip(*pairs)), k + 1)
                        pairs, held_pairs = [(i, j, score)], len(i)
            if pairs:
                i, j, score = best_pairs(q, x, *(np.concatenate(p) for p in zip(*pairs)), k + 1)
                found.append((i + a, j, score))
        return result(queries, held, found)

    def score_all(key: tuple, queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """All pairs of a block of queries and a block of vectors."""
        found = []
        if len(queries) and len(held):
            x = unraw(held.v)
            for a in range(0, len(queries), 500):
                q = unraw(queries.v.iloc[a : a + 500])
                rough = q @ x.T
                i, j = np.divmod(np.arange(rough.size), len(x))
                i, j, score = best_pairs(q, x, i, j, rough.ravel(), k + 1)
                found.append((i + a, j, score))
        return result(queries, held, found)

    schema = "query long, node long, score double"
    ranged = banded.join(F.broadcast(tops), "band")
    asking = banded.join(asked.select("node").distinct(), "node")
    indexed = ranged.mapInPandas(index, "band long, range long, node long, code long, v binary")
    # Ranges far larger than a block are few; they are split, and the queries that probe them go to every part.
    crowded = stored(indexed.groupBy("band", "range").agg(F.ceil(F.count("*") / (2 * block)).alias("parts")).where("parts > 1"))
    keys = ["band", "range", "part"]
    parts = F.coalesce("parts", F.lit(1))
    held = indexed.join(small(crowded), ["band", "range"], "left").withColumn("part", F.pmod(F.xxhash64("node"), parts)).drop("parts")

    def probed(asking: DataFrame, first: bool) -> DataFrame:
        probing = asking.mapInPandas(ask(first), "band long, range long, node long, codes binary, v binary, least double")
        probing = probing.join(small(crowded), ["band", "range"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
        return stored(probing.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(score_codes, schema))

    pairs = probed(asking.withColumn("least", F.lit(float("-inf"))), True)
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    bounds = pairs.distinct().withColumn("nth", nth).where(F.col("nth") == k + 1).select(F.col("query").alias("node"), F.col("score").alias("least"))
    pairs = pairs.unionByName(probed(asking.join(bounds, "node", "left").fillna(float("-inf"), ["least"]), False))

    def answered(asked: DataFrame, pairs: DataFrame) -> DataFrame:
        # The k + 1 nearest nodes hold the k nearest rows other than the query's own.
        pairs = pairs.distinct()
        nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
        best = pairs.withColumn("nth", nth).where(F.col("nth") <= k + 1).select("query", "node", (-F.col("score")).alias("far"))
        # Ranking with a limit is cut down before the shuffle, so a node of very many rows stays small.
        nth = F.row_number().over(Window.partitionBy("node").orderBy("id"))
        smallest = members.join(best.select("node").distinct(), "node").withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        near = best.join(smallest, "node").select("query", "far", F.explode("ids").alias("vec_id"))
        near = near.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("far", "vec_id"))), 1, k + 1).alias("near"))
        others = F.slice(F.filter("near", lambda x: x.vec_id != F.col("id")), 1, k)
        return asked.join(near, F.col("node") == F.col("query"), "left").select("node", "id", F.coalesce(others, F.array().cast("array<struct<far: double, vec_id: long>>")).alias("near"))

    answers = stored(answered(asked, stored(pairs)))
    few = F.size("near") < min(k, members.count() - 1)
    lacking = stored(answers.where(few).select("node", "id"))
    lacking_nodes = lacking.select("node").distinct()
    n_lacking, n_nodes = lacking_nodes.count(), nodes.count()
    if n_lacking:
        # Blocks of queries against blocks of all vectors.
        blank, blocks, parts = "band long, node long, v binary", -(-n_lacking // block), -(-n_nodes // block)
        one = lambda n: F.pmod(F.xxhash64("node"), F.lit(n))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
        left = banded.join(lacking_nodes, "node").mapInPandas(packed, blank).withColumn("block", one(blocks)).withColumn("part", each(parts))
        right = banded.mapInPandas(packed, blank).withColumn("part", one(parts)).withColumn("block", each(blocks))
        exact = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(score_all, schema)
        answers = answers.where(~few).unionByName(answered(lacking, exact))
    found = answers.select(F.col("id").alias("query_id"), F.posexplode("near").alias("place", "x"))
    return found.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))
