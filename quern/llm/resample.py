"""Importance resampling of documents towards a target's distribution of word features.

Features are hashed into buckets; counts over all documents and over all target texts give each bucket a gain, and a
document's weight is the floored mean of its features' gains, scored with whole arrays of buckets: words are numbered,
the crc32 of a run of words follows from the crc32 of its parts by tables for the length of what is appended.
A document's score is its weight with Gumbel noise from a hash of its doc_id, so the highest scores are a draw without
replacement.

The draw's last key is found exactly by weighted medians of medians. Keys lie in sorted blocks. Each round, every block
names the median of its remaining keys; the median of these, weighted by the remaining sizes, is the pivot, and each
block counts its keys on both sides of it. A quarter of the remaining keys at least lies on either side, so the side
that can't hold the cutoff is discarded; blocks are written anew when an eighth of them is left. Only the winners are
sorted: Spark ranges them by key, and a range's ranks begin behind the sizes of the ranges before it.

Defined cases: null and empty texts have no words; a document without features has weight 0; a null doc_id has no noise,
so its row has a null score, counts among the documents' features, and is neither drawn nor one of the N. Rows that
repeat a doc_id are a document each; equal scores go to the smaller doc_id, then to the smaller text hash. Empty tables
(of documents or targets) give the counts 0; other columns are ignored.
"""

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quern.llm.common import ALNUM, ALNUM_SQL, raw, slices, texts_of
from quern.scratch import spread, stored

KEY = ["low", "doc_id", "text_hash"]


class Words(dict):
    """word -> number; and arrays by number: the word's crc32, that of a space and the word, and the latter's length."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most, self.words, self.rows = most, [], []
        self.shifts: dict[int, np.ndarray] = {}

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self.words)
        self.words.append(word)
        self.rows.append((zlib.crc32(word), zlib.crc32(b" " + word), len(word) + 1))
        return value

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > self.most:
            self.clear()
            self.words, self.rows = [], []
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return ids, np.array(self.rows, np.int64).reshape(-1, 3)

    def appended(self, before: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """crc32 of texts, whose crc32 is in `before`, followed by a space and the words of ids."""
        out, size = np.zeros(len(ids), np.uint32), rows[ids, 2]
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            if n > 256:  # such words are rare, a table for each length isn't worth its making
                out[at] = [zlib.crc32(b" " + self.words[i], b) for i, b in zip(ids[at].tolist(), before[at].tolist())]
                continue
            if n not in self.shifts:  # crc32 is affine: what the bits before do to it depends on the length appended alone
                zero = zlib.crc32(bytes(n))
                self.shifts[n] = np.array([[zlib.crc32(bytes(n), v << 8 * b) ^ zero for v in range(256)] for b in range(4)], np.uint32)
            own = rows[ids[at], 1].astype(np.uint32)
            for b in range(4):
                own ^= self.shifts[n][b][(before[at] >> np.uint32(8 * b)) & np.uint32(255)]
            out[at] = own
        return out


def bucket_runs(texts: list[bytes], words: Words, longest: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The number of words of each text, and for every run length: (bucket, whether the run is inside its text), by first word."""
    lists = [t.translate(ALNUM).split() for t in texts]
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    ids, rows = words.numbers([w for some in lists for w in some])
    left = np.repeat(np.cumsum(size), size) - np.arange(len(ids))  # words from here to the text's end
    crc, out = rows[ids, 0].astype(np.uint32), []
    for n in range(longest):
        if n:
            crc = words.appended(crc[: max(0, len(crc) - 1)], ids[n:], rows)
        full = np.zeros(len(ids), np.int64)
        full[: len(crc)] = crc % np.uint32(buckets)
        out.append((full, left > n))
    return size, out


def bucket_counts(rows: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts lie in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(), np.zeros(buckets, np.int64)
        for batch in batches:
            for some in slices(batch, "text"):
                for bucket, inside in bucket_runs(raw(some.column("text")), words, longest, buckets)[1]:
                    total += np.bincount(bucket[inside], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(target: np.ndarray, source: np.ndarray, scale: float = 1000.0) -> np.ndarray:
    """floor(scale * log ratio of the smoothed shares) of every bucket."""
    n, t, s = len(source), int(target.sum()), int(source.sum())
    return np.array([math.floor(scale * math.log((a + 1) * (s + n) / ((b + 1) * (t + n)))) for a, b in zip(target.tolist(), source.tolist())], np.int64)


def noise(doc_id: int, seed: str, scale: float = 1000.0) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int, least: int, seed: str) -> DataFrame:
    """(doc_id, text_hash, n_features, weight, score, fit) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, gain = Words(), held.value
        for batch in batches:
            for some in slices(batch, "text"):
                size, runs = bucket_runs(raw(some.column("text")), words, longest, len(gain))
                stop = np.cumsum(size)
                total, n = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
                for k, (bucket, inside) in enumerate(runs):
                    upto = np.concatenate([[0], np.cumsum(np.where(inside, gain[bucket], 0))])
                    total += upto[stop] - upto[stop - size]
                    n += np.maximum(size - k, 0)
                weight = total // np.maximum(n, 1)
                ids = some.column("doc_id").to_pylist()
                score = [None if i is None else w + noise(i, seed) for i, w in zip(ids, weight.tolist())]
                fit = [i is not None and s >= least for i, s in zip(ids, size.tolist())]
                kept = [some.column("doc_id"), some.column("text_hash"), pa.array(n), pa.array(weight), pa.array(score, pa.int64()), pa.array(fit, pa.bool_())]
                yield pa.RecordBatch.from_arrays(kept, ["doc_id", "text_hash", "n_features", "weight", "score", "fit"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_features long, weight long, score long, fit boolean")


# The selection. A key is three integers, compared one after another; smaller keys are drawn first.


def place(keys: np.ndarray, key: tuple, after: bool) -> int:
    """How many of the sorted keys (3 x n) are less than key, or not greater than it."""
    lo, hi = 0, keys.shape[1]
    for row, value in zip(keys, key):
        lo, hi = lo + int(np.searchsorted(row[lo:hi], value, "left")), lo + int(np.searchsorted(row[lo:hi], value, "right"))
    return hi if after else lo


def blocks_of(rows: DataFrame, size: int) -> DataFrame:
    """(keys): sorted keys, `size` of them at most in a row, from rows with the columns of KEY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            keys = np.concatenate(held, axis=1)
            return pa.RecordBatch.from_arrays([pa.array([keys[:, np.lexsort(keys[::-1])].tobytes()], pa.binary())], ["keys"])

        for batch in batches:
            for a in range(0, batch.num_rows, size):
                some = batch.slice(a, size)
                held.append(np.stack([some.column(c).to_numpy() for c in KEY]))
                n += some.num_rows
                if n >= size:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    return rows.select(*KEY).mapInArrow(run, "keys binary")


def unpacked(keys: bytes, low: tuple | None, high: tuple | None) -> np.ndarray:
    """The keys of a block strictly between low and high."""
    keys = np.frombuffer(keys, np.int64).reshape(3, -1)
    return keys[:, 0 if low is None else place(keys, low, True) : keys.shape[1] if high is None else place(keys, high, False)]


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The smallest key such that keys up to it hold half of the weights or more."""
    medians, half, held = sorted(medians), sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        held += n
        if held >= half:
            return key


def counted(blocks: DataFrame, low: tuple | None, high: tuple | None, pivot: tuple | None) -> list:
    """By block, of the keys between low and high: how many are below the pivot and equal to it, and on each side of it
    how many there are and their median. Without a pivot, all keys are above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in batch.column("keys").to_pylist():
                keys = unpacked(block, low, high)
                a, b = (0, 0) if pivot is None else (place(keys, pivot, False), place(keys, pivot, True))
                middle = lambda some: some[:, (some.shape[1] - 1) // 2].tolist() if some.shape[1] else None
                out.append((a, b - a, keys.shape[1] - b, middle(keys[:, :a]), middle(keys[:, b:])))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], ["below", "same", "above", "lower", "upper"])

    return blocks.mapInArrow(run, "below long, same long, above long, lower array<long>, upper array<long>").collect()


def cutoff(rows: DataFrame, wanted, size: int = 1 << 20) -> tuple[tuple | None, int, int]:
    """The key of the last of the smallest keys, how many these are (`wanted` of the number of all), and the rounds taken."""
    blocks = stored(blocks_of(rows, size))
    parts, low, high, rounds = counted(blocks, None, None, None), None, None, 0
    medians = [(tuple(r["upper"]), r["above"]) for r in parts if r["above"]]
    left = written = sum(n for _, n in medians)
    number = rank = wanted(left)
    if not number:
        return None, 0, 0
    while True:
        rounds += 1
        pivot = weighted_median(medians)
        parts = counted(blocks, low, high, pivot)
        below, same = sum(r["below"] for r in parts), sum(r["same"] for r in parts)
        if below < rank <= below + same:
            return pivot, number, rounds
        if rank <= below:
            high, medians = pivot, [(tuple(r["lower"]), r["below"]) for r in parts if r["below"]]
        else:
            low, rank, medians = pivot, rank - below - same, [(tuple(r["upper"]), r["above"]) for r in parts if r["above"]]
        left = sum(n for _, n in medians)
        if left * 8 <= written:
            blocks, written = stored(remaining(blocks, low, high)), left


def remaining(blocks: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    """The blocks without the keys that are discarded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.ascontiguousarray(unpacked(b, low, high)).tobytes() for b in batch.column("keys").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([k for k in kept if k], pa.binary())], ["keys"])

    return blocks.mapInArrow(run, "keys binary")


def ranked(winners: DataFrame, number: int) -> DataFrame:
    """winners with their rank by KEY, null from number + 1 on."""
    spark = winners.sparkSession
    ranges = winners.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *KEY).sortWithinPartitions(*KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            nth = pa.array(np.arange(n + 1, n + batch.num_rows + 1))
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), nth], [*batch.schema.names, "part", "nth"])

    schema = StructType([*ranges.schema.fields, StructField("part", IntegerType()), StructField("nth", LongType())])
    placed = stored(ranges.mapInArrow(run, schema))
    # One row a range, as many as there are shuffle partitions.
    sizes, starts, before = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect()), [], 0
    for part, n in sizes:
        starts.append((part, before))
        before += n
    rank = F.col("before") + F.col("nth")
    out = placed.join(F.broadcast(spark.createDataFrame(starts, "part int, before long")), "part")
    return out.withColumn("rank", F.when(rank <= number, rank)).drop("part", "nth", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, longest: int = 2, buckets: int = 10_000, least: int = 20, seed: str = "7") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank counts those drawn, `percent` of the ones with `least` words or more."""
    texts = spread(texts_of(docs, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")))
    wanted = texts_of(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    gain = gains(bucket_counts(wanted, longest, buckets), bucket_counts(texts, longest, buckets))
    rows = stored(scored(texts, gain, longest, least, seed)).withColumn("low", -F.col("score"))
    key, number, _ = cutoff(rows.where("fit"), lambda n: percent * n // 100)
    out = ["doc_id", "n_features", "weight", "score"]
    if key is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    a, b, c = (F.lit(v).cast("long") for v in key)
    low, doc, text = (F.col(x) for x in KEY)
    drawn = F.col("fit") & ((low < a) | ((low == a) & ((doc < b) | ((doc == b) & (text <= c)))))
    rest = rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.where(drawn), number).select(*out, "rank").unionByName(rest)


def sql(percent: int = 25, buckets: int = 10_000, least: int = 20, seed: str = "7") -> str:
    """The same for runs of 1 to 2 words in DuckDB's SQL, over the tables `documents` and `benchmark`; crc32 goes byte by byte."""
    table = [zlib.crc32(bytes([v]), 0xFFFFFFFF) ^ 0xFFFFFFFF for v in range(256)]
    runs = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    byte = "CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)"
    step = f"xor(c >> 8, {table}[xor(c & 255, b) + 1])"
    share = f"(t + 1) * ((SELECT sum(s) FROM n) + {buckets}) / ((s + 1) * ((SELECT sum(t) FROM n) + {buckets}))"
    return rf"""WITH d AS MATERIALIZED (SELECT doc_id, len(w) AS n_words, {runs} AS f FROM (SELECT doc_id, {ALNUM_SQL} AS w FROM documents)),
 b AS MATERIALIZED (SELECT {runs} AS f FROM (SELECT {ALNUM_SQL} AS w FROM benchmark)),
 distinct_features AS (SELECT unnest(f) AS feature FROM d UNION SELECT unnest(f) FROM b),
 crc AS MATERIALIZED (SELECT feature, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2), lambda i: {byte})), lambda c, b: {step}), 4294967295) % {buckets} AS bucket
 FROM (SELECT feature, hex(encode(feature)) AS h FROM distinct_features)),
 own AS MATERIALIZED (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(f) AS feature FROM d) JOIN crc USING (feature)),
 n AS MATERIALIZED (SELECT bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM (SELECT bucket, count(*) AS s FROM own GROUP BY bucket)
 FULL JOIN (SELECT bucket, count(*) AS t FROM (SELECT unnest(f) AS feature FROM b) JOIN crc USING (feature) GROUP BY bucket) USING (bucket)),
 gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST({share.split(' / ')[0]} AS DOUBLE) / CAST({share.split(' / ')[1]} AS DOUBLE))) AS BIGINT) AS gain FROM n),
 total AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS total, count(*) AS k FROM own JOIN gain USING (bucket) GROUP BY doc_id),
 weighed AS (SELECT doc_id, n_words, CAST(len(f) AS BIGINT) AS n_features, coalesce((total - (total % k + k) % k) // k, 0) AS weight,
 CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN total USING (doc_id)),
 scored AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM weighed),
 drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= {least} QUALIFY rank <= {percent} * count(*) OVER () // 100)
 SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)"""
