"""Language-model scores of whole documents: a smoothed unigram base, and a gated recurrent model.

1. Counts of all training tokens are aggregated by Spark. The `classes` squared less two most frequent words, the end
   and the unknown token are the recurrent model's slots; every other word is an unknown token times its smoothed share
   among the rest.
2. Texts are read once more and become arrays of slots, with the counts of their rarer words, in a table of their own.
3. Training runs in `rounds` over disjoint parts of the training documents that add up to all of them. A round's
   documents are dealt by a hash of id and text into shards of about `shard` tokens; every shard trains from the round's
   first weights, and the weights are averaged by tokens, in a tree. The number of shards grows with the corpus, and
   neither shards nor their order depend on how the table is partitioned.
4. Every document is scored from its slots, the state carried from window to window.

Counts of at most `table` frequent words and the slots go to all tasks (a fixed bound). Counts of rarer words meet their
documents in a join on the word, one row for each distinct rare word of a document.

Defined cases: a null or empty text is its end alone; documents with a null doc_id are neither held out nor learned
from; rows that repeat doc_id and text get equal scores; without training documents all slots are equally likely and
the base is 0; texts of any length are scored whole, the state carried along; other columns are ignored.
"""

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import gru
from quern.llm.common import LOWER, raw, remainder, slices, texts_of
from quern.scratch import spread, stored

END = b""  # no word is empty


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each token stands in the texts; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for some in slices(batch, "text"):
                for text in raw(some.column("text")):
                    counts.update(text.translate(LOWER).split())
                counts[END] += len(some)
                if len(counts) > 600_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                    counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return spread(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words and their counts, in order: as many whole levels of frequency as hold at most `most` words.

    A level is a factor of 2 ** (1 / 32), so their table is small; only the words chosen reach the driver.
    """
    level = F.floor(F.log2("n") * 32)
    left, least = most, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        left -= r["count"]
        if left < 0:
            break
        least = r["level"]
    if least is None:
        return []
    rows = counts.where(level >= least).toArrow()
    return sorted(zip(rows.column("word").to_pylist(), rows.column("n").to_pylist()), key=lambda x: (-x[1], x[0]))


def averaged(slots: DataFrame, weights: dict, end: int, branch: int = 64, blocks: int = 16) -> dict:
    """The weights after every shard of slots (shard, doc_id, text_hash, slots) has trained from `weights`, averaged by tokens."""
    shared = slots.sparkSession.sparkContext.broadcast(weights)
    sizes = [weights[k].size for k in gru.NAMES]

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])
        docs = [np.frombuffer(x, np.uint16) for x in table.column("slots").to_pylist()]
        trained, n = gru.train(shared.value, docs, end), float(sum(map(len, docs)))
        flat = np.concatenate([trained[k].ravel() for k in gru.NAMES]).astype(np.float64) * n
        parts = np.array_split(np.append(flat, n), blocks)
        shard = table.column("shard")[0].as_py()
        return pa.table({"block": np.arange(blocks), "shard": np.full(blocks, shard), "total": pa.array([x.tobytes() for x in parts], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        total = np.sum([np.frombuffer(x) for x in table.column("total").to_pylist()], 0)
        return pa.table({"block": table.column("block")[:1], "shard": table.column("shard")[:1], "total": pa.array([total.tobytes()], pa.binary())})

    kind = "block long, shard long, total binary"
    rows = slots.groupBy("shard").applyInArrow(learn, kind)
    sums = rows.withColumn("branch", F.pmod("shard", F.lit(branch))).groupBy("block", "branch").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind).collect()
    if not sums:
        return weights
    flat = np.concatenate([np.frombuffer(r["total"]) for r in sorted(sums, key=lambda r: r["block"])])
    flat = (flat[:-1] / flat[-1]).astype(np.float32)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    return {k: x.reshape(weights[k].shape) for k, x in zip(gru.NAMES, parts)}


def learned_weights(slots: DataFrame, weights: dict, end: int, rounds: int, shard: int) -> dict:
    """The weights after training on all rows of slots (doc_id, text_hash, n_tokens, slots), once each."""
    for r in range(rounds):
        part = slots.where(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(rounds)) == r)
        shards = max(1, -(-(part.agg(F.sum("n_tokens")).first()[0] or 0) // shard))
        dealt = part.withColumn("shard", F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(shards)))
        weights = averaged(dealt.select("shard", "doc_id", "text_hash", "slots"), weights, end)
    return weights


def encoded(texts: DataFrame, vocabulary) -> DataFrame:
    """texts (doc_id, text_hash, held_out, learned, text) as slots, with what the tables of counts say of their tokens.

    vocabulary: a broadcast of (word -> place in the next two, log10 of count + 0.5, slot); the unknown slot is the last.
    common and outside sum the logs of known words, and of those beyond the slots; words and times list the rare words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, logs, slot = vocabulary.value
        get, unknown = place.get, len(logs) - 1
        beyond, row = slot == slot[unknown], TaskContext.get().partitionId() << 40
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                places, seldom = [], []
                for text in raw(some.column("text")):
                    words = [*text.translate(LOWER).split(), END]
                    places.append(np.fromiter(map(get, words, repeat(unknown)), np.int32, len(words)))
                    seldom.append(Counter([words[i] for i in np.flatnonzero(places[-1] == unknown).tolist()]))
                at, sizes = np.concatenate(places), np.fromiter(map(len, places), np.int64, len(places))
                ends = np.cumsum(sizes)
                first, rare, outside, log = ends - sizes, at == unknown, beyond[at], logs[at]
                kept = {c: some.column(c) for c in ("doc_id", "text_hash", "held_out", "learned")}
                ids = pa.array(np.arange(row, row + len(some)))
                row += len(some)
                slots = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((2 * np.append(0, ends)).astype(np.int32)), pa.py_buffer(slot[at])])
                sums = [sizes - np.add.reduceat(rare, first, dtype=np.int64), np.add.reduceat(outside, first, dtype=np.int64), np.add.reduceat(log, first), np.add.reduceat(log * outside, first)]
                cols = [*map(pa.array, [sizes, *sums]), slots, pa.array(map(list, seldom), pa.list_(pa.binary())), pa.array([list(x.values()) for x in seldom], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids, *kept.values(), *cols], ["row", *kept, "n_tokens", "n_common", "n_outside", "common", "outside", "slots", "words", "times"])

    schema = "row long, doc_id long, text_hash long, held_out boolean, learned boolean, n_tokens long, n_common long, n_outside long, common double, outside double, slots binary, words array<binary>, times array<long>"
    return spread(texts).mapInArrow(run, schema)


def modelled(rows: DataFrame, weights: dict, end: int) -> DataFrame:
    """rows with `model`, the recurrent model's log10 probability of their slots, instead of slots."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, weights["E"] @ weights["W"] + weights["b"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, gates = shared.value
        for batch in batches:
            for some in slices(batch, "slots", 2 << 20):  # many documents at once fill the lanes beside a long one
                found = gru.score(weights, gates, [np.frombuffer(x, np.uint16) for x in some.column("slots").to_pylist()], end) / math.log(10)
                kept = {c: some.column(c) for c in some.schema.names if c != "slots"}
                yield pa.RecordBatch.from_arrays([*kept.values(), pa.array(found)], [*kept, "model"])

    return rows.mapInArrow(run, rows.drop("slots").schema.add("model", "double"))


def score_texts(docs: DataFrame, folds: int = 5, fold: int = 1, classes: int = 48, hidden: int = 16, inputs: int = 16, table: int = 100_000, rounds: int = 3, shard: int = 1_000_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, in log10.

    Documents whose crc32(doc_id) modulo `folds` is `fold` are held out. classes: of the output, and words of a class.
    """
    spark = docs.sparkSession
    kept = remainder("doc_id", folds)
    texts = texts_of(docs)
    counts = stored(token_counts(texts.where(kept != fold)))
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds")).first()
    tokens, kinds = totals["tokens"] or 0, totals["kinds"]
    # The end token first, then exactly the most frequent words.
    top = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(F.length("word") > 0, F.desc("n"), "word").limit(classes * classes - 1).collect()]
    words = [END, *[w for w, _ in top if w != END]]
    known = {END: 0} | dict(top)
    rest, rest_kinds = tokens - sum(known.values()), kinds - sum(n > 0 for n in known.values())
    frequency = np.zeros(classes * classes)
    frequency[: len(words)] = [known[w] for w in words]
    unknown = len(words)
    frequency[unknown] = rest
    known |= dict(most_frequent(counts, table))
    logs = np.log10(np.array([n + 0.5 for n in known.values()] + [1.0]))
    slot = np.full(len(known) + 1, unknown, np.uint16)
    places = {w: i for i, w in enumerate(known)}
    slot[[places[w] for w in words]] = np.arange(len(words))
    vocabulary = spark.sparkContext.broadcast((places, logs, slot))

    keyed = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(kept == fold, F.lit(False)).alias("held_out"), F.coalesce(kept != fold, F.lit(False)).alias("learned"), "text")
    rows = stored(encoded(keyed, vocabulary))
    weights = learned_weights(rows.where("learned"), gru.initial(frequency, classes, hidden, inputs), 0, rounds, shard)

    scored = modelled(rows.drop("learned", "words", "times", "text_hash"), weights, 0)
    seldom = rows.where("size(words) > 0").select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times")))).toDF("row", "word", "times")
    found = seldom.join(counts, "word", "left").fillna(0, ["n"])
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("rare"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_rare"))
    both = scored.join(sums, "row", "left").fillna(0, ["rare", "n_rare"])
    base_log, rest_log = math.log10(tokens + 0.5 * (kinds + 1)), math.log10(rest + 0.5 * (rest_kinds + 1))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.col("n_rare") - (0 if known[END] else 1)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("common") + F.col("rare") - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("model") + F.col("outside") + F.col("rare") - F.col("n_outside") * rest_log).alias("score"),
    )
