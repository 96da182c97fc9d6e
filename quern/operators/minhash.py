"""Near-duplicate removal by character shingles, MinHash, banded LSH and exact Jaccard similarity.

Rows are ranked by length (longer first), then by id. The greedy form removes a row if and only if a surviving row of
better rank is similar; the one-shot form removes it if any row of better rank is. Rows whose normalised text is equal
are collapsed first, since they have equal shingles: only the best of them can survive.

Rows that lead all their buckets survive; they are compared with the others of those buckets, which removes a group of
copies at the cost of its size. This is repeated while it removes a good share of the rows, so a few times at most.
What is left shares buckets but is mostly unlike. Its buckets are cut into chunks of bounded size, and every two chunks
of a bucket meet in a task, which gives only the pairs that are similar. The greedy form then decides on those links.

Only texts of rows that share a bucket are written and travel, as texts: sets of shingle hashes are made where they are
compared, being several times as large. Buckets of the same rows, as near copies have in most bands, are compared once.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import strip
from quern.scratch import joined, small, spread, stored

# The hash family.
LARGEST, PRIME, SEED = 2**32 - 1, 4294967311, 42


def normalised(text: Column) -> Column:
    return strip(F.lower(F.coalesce(text, F.lit(""))))


def shingles(text: Column, k: int = 5) -> Column:
    """Distinct character k-grams of the lower-cased, stripped text; the text itself if it is shorter."""
    chars = F.split(normalised(text), "")
    gram = lambda c: lambda i: F.concat(*[F.get(c, i + j) for j in range(k)])
    # The one-element transform computes the characters once a row instead of once a shingle.
    grams = F.transform(F.array(chars), lambda c: F.when(F.size(c) < k, F.array(F.array_join(c, ""))).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(c) - k, F.lit(0))), gram(c)))))
    return F.get(grams, 0)


def base_hash(shingle: Column) -> Column:
    """md5 modulo 2^32 - 1: the sum of the digest's four words, modulo 2^32 - 1."""
    digest = F.md5(shingle.cast("binary"))
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    return F.pmod(words[0] + words[1] + words[2] + words[3], F.lit(LARGEST))


def family(permutations: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.RandomState(seed)
    return random.randint(1, LARGEST, permutations), random.randint(0, LARGEST, permutations)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of (a * h + b) modulo PRIME in wrapping 64-bit arithmetic, at most 2^32 - 1."""
    out = np.full(len(a), LARGEST, np.int64)
    for at in range(0, len(hashes), 4096):
        out = np.minimum(out, ((a[:, None] * hashes[None, at : at + 4096] + b[:, None]) % PRIME).min(1))
    return out


def text_hashes(text: str, k: int, known: dict[str, int]) -> np.ndarray:
    """base_hash of each distinct shingle of a normalised text. known: the hashes so far, kept by the caller for its task."""
    if len(known) > 1_000_000:
        known.clear()
    grams = {text[i : i + k] for i in range(len(text) - k + 1)} if len(text) >= k else {text}
    for g in grams.difference(known):
        known[g] = int.from_bytes(hashlib.md5(g.encode()).digest(), "big") % LARGEST
    return np.fromiter(map(known.__getitem__, grams), np.int64, len(grams))


def hash_ranges(df: DataFrame, id_col: str = "id", k: int = 5) -> DataFrame:
    """(id, least, greatest, n) of the base hashes of the distinct shingles of (id, text_norm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            found = [(h.min(), h.max(), len(h)) for h in (text_hashes(text, k, known) for text in batch.column("text_norm").to_pylist())]
            columns = np.array(found, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *(pa.array(np.ascontiguousarray(c)) for c in columns)], [id_col, "least", "greatest", "n"])

    return spread(df.select(id_col, "text_norm")).mapInArrow(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, least long, greatest long, n long")


def signatures(df: DataFrame, id_col: str = "id", permutations: int = 128, k: int = 5, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., signature) from (id, text_norm, keep...)."""
    a, b = family(permutations, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            rows = [signature(text_hashes(text, k, known), a, b) for text in batch.column("text_norm").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))], [*own, "signature"])

    own = [id_col, *keep]
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in own)
    return spread(df.select(*own, "text_norm")).mapInArrow(run, f"{kinds}, signature array<long>")


def bands(signed: DataFrame, id_col: str = "id", n_bands: int = 16) -> DataFrame:
    """(id, ..., band, key): one row for each band of a signature; rows beyond a whole number of bands are left out."""
    rows = F.floor(F.size("signature") / n_bands).cast("int")
    keys = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.xxhash64(F.slice("signature", i * rows + 1, rows)))
    return signed.select(*[c for c in signed.columns if c != "signature"], F.posexplode(keys).alias("band", "key"))


def candidates(banded: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct pairs (a, b), a < b, that share a bucket."""
    x, y = banded.select(F.col(id_col).alias("a"), "band", "key"), banded.select(F.col(id_col).alias("b"), "band", "key")
    return x.join(y, ["band", "key"]).where("a < b").select("a", "b").distinct()


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct values; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def gram_set(text: str, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a normalised text's shingles."""
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = min(k, len(chars))
    n = len(chars) - size + 1
    out = np.full(n, size + 1, np.uint64)
    for j in range(size):
        out = (out + chars[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def compared(shared: DataFrame, texts: DataFrame, threshold: float, all_pairs: bool, k: int = 5, chunk: int = 200) -> DataFrame:
    """Similar rows among those that share a bucket: pairs (better, worse, jaccard), or the worse row alone, once a task.

    shared: (band, key, id, rank, target), rank being (far, id); only rows marked as targets are looked at as the worse
    one, and only buckets with a better row than some target. Of buckets that hold the same rows one is looked at. Its
    rows are dealt in chunks of about `chunk`, and each two chunks (or one with itself) meet in a task.
    """
    members = [F.bit_xor(F.xxhash64(F.lit(i), "id")).alias(f"members{i}") for i in range(2)]
    buckets = shared.groupBy("band", "key").agg(F.count("*").alias("n"), *members, F.min("rank").alias("top"), F.max(F.when(F.col("target"), F.col("rank"))).alias("last"))
    unlike = buckets.where("n > 1 AND last > top").groupBy("n", "members0", "members1").agg(F.min(F.struct("band", "key")).alias("one"))
    places = stored(unlike.select("one.band", "one.key", F.ceil(F.col("n") / chunk).alias("chunks"), "n"))
    dealt = joined(shared.select("band", "key", "id", "rank", "target"), places, ["band", "key"]).withColumn("part", F.pmod(F.xxhash64("id"), "chunks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("band", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "rank.far", "target").join(texts, "id")
    kind = shared.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("far", "ascending"), ("id", "ascending")])
        sets = [gram_set(t.as_py(), k) for t in table.column("text_norm")]
        size = np.array([len(s) for s in sets])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        start, mark = np.cumsum(size) - size, np.zeros(len(names), bool)
        part, target = (table.column(c).to_numpy() for c in ("part", "target"))
        alone, better, worse, found = len(np.unique(part)) == 1, [], [], []
        for i in np.flatnonzero(target).tolist():
            # Sizes that differ too much leave no such similarity.
            may = (alone | (part[:i] != part[i])) & (np.minimum(size[:i], size[i]) >= threshold * np.maximum(size[:i], size[i]))
            j = np.flatnonzero(may)
            if not len(j):
                continue
            mark[flat[start[i] : start[i] + size[i]]] = True
            both = np.array([np.count_nonzero(mark[flat[start[n] : start[n] + size[n]]]) for n in j])
            mark[flat[start[i] : start[i] + size[i]]] = False
            alike = both / (size[j] + size[i] - both)
            some = np.flatnonzero(alike >= threshold)[: None if all_pairs else 1]
            better += j[some].tolist()
            worse += [i] * len(some)
            found += alike[some].tolist()
        ids = table.column("id")
        return pa.table({"better": ids.take(pa.array(better, pa.int64())), "worse": ids.take(pa.array(worse, pa.int64())), "jaccard": pa.array(found, pa.float64())})

    found = dealt.groupBy("band", "key", "low", "high").applyInArrow(run, f"better {kind}, worse {kind}, jaccard double")
    return found.distinct() if all_pairs else found.select("worse").distinct()


def with_rank(rows: DataFrame) -> DataFrame:
    """(id, rank) of (id, size)."""
    return rows.select("id", F.struct((-F.col("size")).alias("far"), "id").alias("rank"))


def similar_pairs(rows: DataFrame, threshold: float = 0.7, permutations: int = 128, n_bands: int = 16, k: int = 5) -> DataFrame:
    """(a, b, jaccard) of LSH candidates among (id, text_norm, size) with at least the threshold, a < b."""
    shared, texts = crowded_texts(rows, permutations, n_bands, k)
    pairs = compared(shared.withColumn("target", F.lit(True)), texts, threshold, all_pairs=True, k=k)
    return pairs.select(F.least("better", "worse").alias("a"), F.greatest("better", "worse").alias("b"), "jaccard")


def crowded_texts(rows: DataFrame, permutations: int, n_bands: int, k: int) -> tuple[DataFrame, DataFrame]:
    """((band, key, id, rank) of buckets with two rows or more, (id, text_norm) of those rows) from (id, text_norm, size)."""
    banded = stored(bands(signatures(rows, permutations=permutations, k=k, keep=("size",)), n_bands=n_bands))
    rank = F.struct((-F.col("size")).alias("far"), "id").alias("rank")
    shared = stored(crowded(banded).select("band", "key", "id", rank))
    ids = stored(shared.select("id").distinct())
    return shared, stored(rows.join(small(ids), "id", "left_semi").select("id", "text_norm"))


def prepared(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_norm, size): the best-ranked row of each normalised text. Raises if the text column is missing."""
    if text_col not in df.columns:
        raise ValueError(f"no column {text_col!r} to compare; columns are {df.columns}")
    rows = df.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text_norm"), F.coalesce(F.length(text_col), F.lit(0)).alias("size"))
    # By digest, so that texts don't travel as keys; and without a shuffle of texts while the rows to go or to stay are few.
    best = stored(rows.groupBy(F.sha2("text_norm", 256).alias("digest")).agg(F.min(F.struct((-F.col("size")).alias("far"), "id")).alias("best")).select("best.id"))
    others = stored(rows.select("id").where("id IS NOT NULL").join(best, "id", "left_anti"))
    if best.count() <= others.count():
        return rows.join(small(best), "id", "left_semi")
    return rows.where("id IS NOT NULL").join(small(others), "id", "left_anti")


def crowded(banded: DataFrame) -> DataFrame:
    """The rows of buckets that hold at least two."""
    many = stored(banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1"))
    return joined(banded, many, ["band", "key"])


def led(shared: DataFrame, texts: DataFrame, threshold: float, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(ids of the rows that lead all their buckets, ids of the rows similar to a leader of a bucket of theirs)."""
    tops = stored(shared.groupBy("band", "key").agg(F.min("rank").alias("top"), F.count("*").alias("n")))
    placed = stored(joined(shared, tops, ["band", "key"]).select("id", F.col("top.id").alias("top"), (F.col("rank") > F.col("top")).alias("beaten")).distinct())
    leaders = stored(placed.groupBy("id").agg(F.bool_or("beaten").alias("beaten")).where("NOT beaten").select("id"))
    pairs = placed.where("beaten").select(F.col("top").alias("a"), F.col("id").alias("b")).join(leaders.withColumnRenamed("id", "a"), "a", "left_semi").distinct()
    of_leader = texts.join(pairs.groupBy("a").agg(F.count("*").alias("n")).withColumnRenamed("a", "id"), "id").select(F.col("id").alias("a"), F.col("text_norm").alias("x"), "n")
    met = joined(pairs, stored(of_leader), ["a"]).join(texts.select(F.col("id").alias("b"), F.col("text_norm").alias("y")), "b").select("b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                one, other = gram_set(x.as_py(), k), gram_set(y.as_py(), k)
                both = len(np.intersect1d(one, other, assume_unique=True))
                alike.append(both / (len(one) + len(other) - both) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("b").filter(pa.array(alike, pa.bool_()))], ["id"])

    return leaders, stored(met.mapInArrow(run, f"id {shared.schema['id'].dataType.simpleString()}").distinct())


def survivors_of_links(links: DataFrame, rank: DataFrame, few: int = 1_000_000) -> DataFrame:
    """Ids that go if, in order of rank, a row goes whenever a better one it is linked with stays. links: (better, worse).

    While there are more than `few` links, rows without a better one left are settled in rounds, all at a time; the last
    `few` are walked through in one task, since a long chain of links would take as many rounds as it has rows.
    """
    gone, kind = links.select(F.col("worse").alias("id")).limit(0), links.schema["worse"].dataType.simpleString()
    while links.count() > few:
        stay = links.select(F.col("better").alias("id")).distinct().join(links.select(F.col("worse").alias("id")), "id", "left_anti")
        out = stored(links.join(stay.withColumnRenamed("id", "better"), "better", "left_semi").select(F.col("worse").alias("id")).distinct())
        gone = gone.union(out)
        for side in ("better", "worse"):
            links = links.join(out.withColumnRenamed("id", side), side, "left_anti")
        links = stored(links.join(stay.withColumnRenamed("id", "better"), "better", "left_anti"))

    def walk(table: pa.Table) -> pa.Table:
        better: dict = {}
        for b, w, far in zip(*(table.column(c).to_pylist() for c in ("better", "worse", "far"))):
            better.setdefault((far, w), []).append(b)
        out: set = set()
        for far, w in sorted(better):
            if any(b not in out for b in better[far, w]):
                out.add(w)
        return pa.table({"id": pa.array(list(out), table.schema.field("worse").type)})

    last = links.join(rank.select(F.col("id").alias("worse"), "rank.far"), "worse").withColumn("one", F.lit(1))
    return gone.union(last.groupBy("one").applyInArrow(walk, f"id {kind}"))


def removed(rows: DataFrame, threshold: float, permutations: int, n_bands: int, k: int, greedy: bool) -> DataFrame:
    """Ids among (id, text_norm, size) that a better row removes: any better one, or (greedy) any that survives."""
    shared, texts = crowded_texts(rows, permutations, n_bands, k)
    rank = shared.select("id", "rank").distinct()
    if not greedy:
        _, gone = led(shared, texts, threshold, k)
        target = shared.join(gone.withColumn("out", F.lit(True)), "id", "left").withColumn("target", F.col("out").isNull()).drop("out")
        return gone.union(compared(target, texts, threshold, False, k)).distinct()
    gone, n = shared.select("id").limit(0), shared.select("id").distinct().count()
    while n:
        leaders, out = led(shared, texts, threshold, k)
        gone = gone.union(out)
        shared = stored(crowded(shared.join(out.union(leaders), "id", "left_anti")))
        before, n = n, shared.select("id").distinct().count()
        if n > before * 0.8:
            links = stored(compared(shared.withColumn("target", F.lit(True)), texts, threshold, True, k).select("better", "worse"))
            return gone.union(survivors_of_links(links, rank))
    return gone


def deduplicate(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.7, permutations: int = 128, n_bands: int = 16, k: int = 5, greedy: bool = True) -> DataFrame:
    """The surviving rows of df."""
    rows = prepared(df, id_col, text_col)
    gone = removed(rows, threshold, permutations, n_bands, k, greedy)
    kept = rows.select("id").join(gone, "id", "left_anti").withColumnRenamed("id", id_col)
    return df.join(kept, id_col, "left_semi")


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Original, kept and removed rows and the percentage kept (null for an empty table)."""
    counts = before.agg(F.count("*").alias("original")).crossJoin(after.agg(F.count("*").alias("kept")))
    return counts.select("original", "kept", (F.col("original") - F.col("kept")).alias("removed"), (F.col("kept") * 100.0 / F.nullif(F.col("original"), F.lit(0))).alias("kept_percent"))


def exact_dedup(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row with the smallest id of each text."""
    first = df.groupBy(F.sha2(text_col, 256).alias("digest")).agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(first, id_col, "left_semi")


def best_per_group(df: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """The first row of each group in an order."""
    nth = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("nth", nth).where("nth = 1").drop("nth")
