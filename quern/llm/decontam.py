"""Benchmark decontamination on a distributed positional inverted index of the training tokens.

1. Benchmark items are cut into windows (of `size` words, or the whole item if it is shorter). Every document's
   occurrences of the benchmark's terms are counted, and each window's rarest terms become its keys, `misses` + 2 of them.
2. The index stores postings (term, document, position) of the training tokens; only the lists of key terms are needed,
   and of these no posting that meets no other of its document on any diagonal of step 3 (unless one key is enough).
3. Each list is shifted by its term's place in the item, which leaves diagonals (document position - item position).
   Where a window's shifted lists intersect, all of them or all but `misses`, on one diagonal or on neighbouring ones,
   `misses` apart at most, these diagonals are candidates. Postings meet by blocks of diagonals, whose edges overlap.
4. Candidates meet the text, one list of diagonals for each document and item. Exact phrases are confirmed word by word.
   Proximity matches are windows within `misses` words added, dropped or replaced of a stretch of the text: such edits
   take `misses` keys at most and leave the others on diagonals `misses` apart at most, so none is overlooked, whichever
   words they change.

Item and document may be of any size: the benchmark's terms, windows and texts are sent to all tasks only while it has
at most `small` words, else they are matched by joins alone.

Defined cases: null and empty texts have no words and neither hit nor are hit; a document or item of any length is
read whole; repeated rows of a document are reported each, repeated items once by item_id; a null item_id takes part
as the empty string; rows with a null doc_id are searched like others; items shorter than `size` words have no
proximity matches; empty tables give no hits; other columns are ignored.
"""

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import ALNUM, ALNUM_SQL, ROW, named_rows, raw, slices, texts_of
from quern.scratch import spread, stored

WORDS = "transform(filter(split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+'), w -> w <> ''), w -> CAST(w AS BINARY))"

#: Neighbouring diagonals whose postings meet together.
BLOCK = 8


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(item_id, at, terms): every window's first place in its item, and its words."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.expr(WORDS).alias("words")).where("size(words) > 0")
    starts = words.select("item_id", "words", F.explode(F.expr(f"sequence(0, greatest(size(words) - {size}, 0))")).alias("at"))
    return starts.select("item_id", "at", F.expr(f"slice(words, at + 1, {size})").alias("terms"))


def term_counts(docs: DataFrame, wanted) -> DataFrame:
    """Partial counts (term, n) of the training tokens. wanted: a broadcast set of the only terms to count, or None for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        only = None if wanted is None else wanted.value.__contains__
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                for text in raw(some.column("text")):
                    words = text.translate(ALNUM).split()
                    counts.update(words if only is None else filter(only, words))
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
                counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    return spread(texts_of(docs).select("text")).mapInArrow(run, "term binary, n long")


class Lists:
    """Where key terms stand in items: for each term's number, places and numbers of items.

    alone: whether one key of an item's window is enough.
    """

    def __init__(self, rows: pa.Table):
        names = rows.column("term").to_pylist()
        self.number = {w: i for i, w in enumerate(dict.fromkeys(names))}
        term = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        order = np.argsort(term, kind="stable")
        self.start = np.searchsorted(term[order], np.arange(len(self.number) + 1))
        items, alone = rows.column("item_id").to_pylist(), rows.column("alone").to_numpy()
        of = {x: i for i, x in enumerate(dict.fromkeys(items))}
        self.items, self.item = len(of), np.fromiter(map(of.__getitem__, items), np.int64, len(items))[order]
        self.place, self.alone = rows.column("place").to_numpy()[order].astype(np.int64), alone[order].astype(bool)

    def meeting(self, term: np.ndarray, row: np.ndarray, position: np.ndarray, misses: int, most: int = 4_000_000) -> np.ndarray:
        """Which postings meet another of their row: on a diagonal of one item, or on two that are `misses` apart at most.

        All of them, if they have more than `most` diagonals: Spark compares those.
        """
        many = self.start[term + 1] - self.start[term]
        total = int(many.sum())
        if not 0 < total <= most:
            return np.ones(len(term), bool)
        posting = np.repeat(np.arange(len(term)), many)
        at = np.arange(total) - np.repeat(np.cumsum(many) - many - self.start[term], many)
        diagonal = position[posting] - self.place[at]
        diagonal -= diagonal.min()
        met = (row[posting] * self.items + self.item[at]) * (int(diagonal.max()) + misses + 1) + diagonal
        order = np.argsort(met)
        close = np.diff(met[order]) <= misses
        keep, kept = np.zeros(len(term), bool), self.alone[at[order]]
        kept[1:] |= close
        kept[:-1] |= close
        keep[posting[order[kept]]] = True
        return keep


def postings(docs: DataFrame, wanted, misses: int) -> DataFrame:
    """Postings (term, key, unnamed, position) of the training tokens: all, or with wanted, a broadcast of Lists, those that may meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = None if wanted is None else wanted.value
        names = None if lists is None else pa.array(list(lists.number), pa.binary())
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                texts = (text.translate(ALNUM).split() for text in raw(some.column("text")))
                if lists is None:
                    texts = list(texts)
                    sizes = [len(words) for words in texts]
                    terms = pa.array([w for words in texts for w in words], pa.binary())
                    row, position = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])
                else:
                    found = [np.fromiter(map(lists.number.get, words, repeat(-1)), np.int64, len(words)) for words in texts]
                    places = [np.flatnonzero(x >= 0) for x in found]
                    term, position = np.concatenate([x[at] for x, at in zip(found, places)]), np.concatenate(places)
                    row = np.repeat(np.arange(len(places)), [len(x) for x in places])
                    keep = lists.meeting(term, row, position, misses)
                    terms, row, position = names.take(pa.array(term[keep])), row[keep], position[keep]
                rows = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([terms, some.column("key").take(rows), some.column("unnamed").take(rows), pa.array(position, pa.int64())], ["term", *ROW, "position"])

    return spread(named_rows(docs).select(*ROW, "text")).mapInArrow(run, "term binary, key long, unnamed boolean, position long")


def total_words(items: DataFrame) -> int:
    return items.select(F.sum(F.expr(f"size({WORDS})"))).first()[0] or 0


def candidates(docs: DataFrame, items: DataFrame, size: int, misses: int, few: bool) -> DataFrame:
    """(key, unnamed, item_id, diagonal): where the key terms of some window stand at their offsets, or all but `misses`."""
    context = docs.sparkSession.sparkContext
    windows = windows_of(items, size)
    vocabulary = context.broadcast({bytes(r[0]) for r in windows.select(F.explode("terms")).distinct().collect()}) if few else None
    counts = term_counts(docs, vocabulary).groupBy("term").agg(F.sum("n").alias("n"))
    places = windows.select("item_id", "at", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term")).join(counts, "term", "left").fillna(0, ["n"])
    rank = F.row_number().over(Window.partitionBy("item_id", "at", "length").orderBy("n", "offset"))
    chosen = stored(places.withColumn("rank", rank).where(F.col("rank") <= misses + 2).select("item_id", "at", "length", "offset", "term"))
    of_window = chosen.groupBy("item_id", "at", "length").agg(F.collect_set(F.col("at") + F.col("offset")).alias("places"))
    needed = F.when(F.col("length") < size, F.size("places")).otherwise(F.greatest(F.size("places") - misses, F.lit(1)))
    of_item = of_window.withColumn("needed", needed).groupBy("item_id").agg(F.collect_set(F.struct("places", "needed")).alias("windows"), F.min("needed").alias("least"))
    of_item = stored(of_item)

    # Windows overlap, so a key term is looked up once for each place in its item; a place and a posting fix a diagonal.
    lists = chosen.select("term", "item_id", (F.col("at") + F.col("offset")).alias("place")).distinct()
    # While the benchmark is small, postings whose diagonals meet no other's don't leave the task that reads their text.
    known = context.broadcast(Lists(lists.join(of_item.select("item_id", (F.col("least") == 1).alias("alone")), "item_id").toArrow())) if few else None
    shifted = postings(docs, known, misses).join(lists, "term").select("item_id", *ROW, (F.col("position") - F.col("place")).alias("diagonal"), "place")
    # A posting within `misses` of its block's end is also in the next block; diagonal, from the block's first, and place are one number.
    blocks = F.array_distinct(F.array(F.floor(F.col("diagonal") / BLOCK), F.floor((F.col("diagonal") + misses) / BLOCK))) if misses else F.array(F.floor(F.col("diagonal") / BLOCK))
    off = F.col("diagonal") - F.col("block") * BLOCK + misses
    shifted = shifted.withColumn("block", F.explode(blocks)).select("item_id", *ROW, "block", (off * F.lit(1 << 32) + F.col("place")).alias("met"), F.call_function("shiftleft", F.lit(1).cast("long"), off.cast("int")).alias("bit"))
    met = shifted.groupBy(*ROW, "item_id", "block").agg(F.collect_set("met").alias("met"), F.bit_or("bit").alias("bits"))
    met = met.join(of_item if vocabulary is None else F.broadcast(of_item), "item_id").where("size(met) >= least")
    # Two postings on one diagonal, or on neighbouring ones; told by bits, since few blocks have any.
    close = (F.col("least") == 1) | (F.size("met") > F.bit_count("bits"))
    for apart in range(1, misses + 1):
        close = close | (F.col("bits").bitwiseAND(F.shiftright("bits", apart)) != 0)
    places = F.transform("met", lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)))
    met = met.where(close).withColumn("places", places).where(F.exists("windows", lambda w: F.size(F.array_intersect(w.places, F.col("places"))) >= w.needed))
    diagonals = F.array_distinct(F.transform("met", lambda x: F.shiftright(x, 32) + F.col("block") * BLOCK - misses))
    return met.select(*ROW, "item_id", F.explode(diagonals).alias("diagonal"))


def within(phrase: list[bytes], text: list[bytes], misses: int) -> bool:
    """Whether some stretch of text is the phrase but for at most `misses` words added, dropped or replaced."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(phrase, 1):
        before, row = row, [i]
        for j, other in enumerate(text):
            row.append(min(before[j] + (word != other), before[j + 1] + 1, row[j] + 1))
        if min(row) > misses:
            return False
    return True


def matches(words: list[bytes], item: list[bytes], diagonals: list[int], size: int, misses: int) -> tuple[set[int], set[int], int, set[int]]:
    """(starts of exact windows in words, those windows, their length, windows near on one of the diagonals)."""
    span, begin, exact, near = min(size, len(item)), set(), set(), set()
    for shift in diagonals:
        low, high = max(0, -shift), min(len(item), len(words) - shift)
        same = np.fromiter((item[i] == words[i + shift] for i in range(low, high)), np.int64, max(0, high - low))
        if len(same) >= span:
            full = np.flatnonzero(np.convolve(same, np.ones(span, np.int64), "valid") == span) + low
            exact.update(full.tolist())
            begin.update((full + shift).tolist())
        if misses and span == size:
            sums = np.concatenate([[0], np.cumsum(same)])
            at = np.arange(len(item) - size + 1)
            # Two words or more stand in place.
            agree = sums[np.clip(at + size - low, 0, len(same))] - sums[np.clip(at - low, 0, len(same))]
            for a in np.flatnonzero(agree >= 2).tolist():
                if a not in near:
                    phrase, text = item[a : a + size], words[max(0, a + shift - misses) : max(0, a + shift + size + misses)]
                    if len(set(phrase).difference(text)) <= misses and within(phrase, text, misses):
                        near.add(a)
    return begin, exact, span, near


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, misses: int = 1, small: int = 500_000) -> DataFrame:
    """(doc_id, text, n_words, n_hit, n_items, items, n_near) of every document row.

    n_hit counts words inside an occurrence of a window, items lists the item_ids with one (sorted), n_near the windows
    that have no exact match there, but a proximity match.
    """
    texts = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("item")
    item_texts = items.select(*texts).dropDuplicates(["item_id", "item"])
    few = total_words(items) <= small
    found = candidates(docs, items, size, misses, few).groupBy(*ROW, "item_id").agg(F.collect_set("diagonal").alias("diagonals"))
    listed = found.join(F.broadcast(item_texts) if few else item_texts, "item_id").groupBy(*ROW).agg(F.collect_list(F.struct("item_id", "item", "diagonals")).alias("places"))
    joined = named_rows(docs).join(listed, ROW, "left").select("doc_id", "text", "places")
    schema = "doc_id long, text string, n_words long, n_hit long, n_items long, items array<string>, n_near long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, places in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text")), batch.column("places").to_pylist()):
                words = text.translate(ALNUM).split()
                if not places:
                    rows.append((doc, len(words), 0, [], 0))
                    continue
                hit, names, exact, near = np.zeros(len(words) + 1, np.int64), set(), set(), set()
                for place in places:
                    name = place["item_id"]
                    begin, own, span, close = matches(words, place["item"].encode().translate(ALNUM).split(), place["diagonals"], size, misses)
                    exact |= {(name, a) for a in own}
                    near |= {(name, a) for a in close}
                    if begin:
                        names.add(name)
                        first = np.fromiter(begin, np.int64, len(begin))
                        hit[first] += 1
                        hit[first + span] -= 1
                rows.append((doc, len(words), int((np.cumsum(hit)[:-1] > 0).sum()), sorted(names), len(near - exact)))
            ids, n, hits, names, near = zip(*rows) if rows else ((), (), (), (), ())
            cols = [pa.array(ids, pa.int64()), batch.column("text"), pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(map(len, names), pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(near, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text", "n_words", "n_hit", "n_items", "items", "n_near"])

    return joined.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """One row per document: counts, a digest of the items found, and the number of proximity matches."""
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def sql(size: int = 10) -> str:
    """The digest, without n_near, in DuckDB's SQL over the tables `documents` and `benchmark`: all grams are looked up."""
    return rf"""WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {ALNUM_SQL} AS w FROM benchmark),
 g AS (SELECT DISTINCT item_id, least(len(w), {size}) AS n, array_to_string(w[a + 1 : a + least(len(w), {size})], ' ') AS gram
 FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {size}, 0) + 1)) AS a FROM i WHERE len(w) > 0)),
 d AS (SELECT doc_id, {ALNUM_SQL} AS w FROM documents),
 p AS (SELECT doc_id, a, n, array_to_string(w[a + 1 : a + n], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS a FROM d, (SELECT DISTINCT n FROM g))),
 m AS MATERIALIZED (SELECT doc_id, a, p.n, item_id FROM p JOIN g USING (n, gram)),
 h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS place FROM m) GROUP BY doc_id),
 k AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM m GROUP BY doc_id)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
 sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)"""
