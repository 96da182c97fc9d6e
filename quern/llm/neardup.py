"""Near-duplicate documents by banded MinHash, odd-sketch filtering and exact verification.

1. Every document gets its set of word shingles (hashed to 64 bits). Documents whose sets have equal hashes are one node,
   after the sets of all of them have been compared with that of the smallest; those that differ become other nodes.
2. A node's MinHash samples give band keys, and fold into an odd sketch: a parity bitmap in which each sample flips one
   bit. The XOR of two sketches keeps only samples that differ, so its population count estimates high similarities.
3. In each band bucket every node is compared with the bucket's smallest node only. The sketch drops clearly unlike
   pairs (six standard deviations below the threshold); the rest are confirmed on full sets.
4. Where a bucket still holds several components beside that node, all nodes compared with it are dealt out in bounded
   chunks, a task for each pair of chunks that isn't of one component. First only sketches meet there; the nodes that
   some node of another component may be similar to meet again with their texts, and full sets are compared. Pairs
   within a component can't change the result, so only links that join components come out, a group of m near copies
   gives about m rows, no cap is needed, and no pair that shares a bucket is lost.

Defined cases: null and empty texts have an empty set, are linked with nothing and are kept; a text of fewer words
than a shingle is one shingle; rows that repeat a doc_id or a text are linked like other documents; a row with a null
doc_id takes part but never names a component and isn't kept; empty tables give no rows; other columns are ignored.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import LOWER, LOWER_SQL, Hashes, mix, raw, shingle_set, slices, texts_of
from quern.llm.components import components
from quern.scratch import joined, spread, stored

ROWS, BANDS, LANES = 5, 35, 8
SKETCH = [f"s{i}" for i in range(LANES)]


def minhashes(sets: list[np.ndarray], samples: int, seed: int = 7) -> np.ndarray:
    """MinHash samples (sample x set) of non-empty sets."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 2**63, samples, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, samples, np.uint64)
    size = np.array([len(s) for s in sets])
    start, values = np.cumsum(size) - size, np.concatenate(sets)
    return np.stack([np.minimum.reduceat(values * a + b, start) for a, b in zip(factor, shift)])


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A key for each band of ROWS samples (set x band), as signed longs."""
    keys = np.arange(len(samples) // ROWS, dtype=np.uint64)[:, None] + np.zeros(samples.shape[1], np.uint64)
    for r in range(ROWS):
        keys = mix(keys + samples[r :: ROWS][: len(keys)])
    return keys.T.view(np.int64) if keys.T.flags.c_contiguous else np.ascontiguousarray(keys.T).view(np.int64)


def odd_sketches(samples: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Parity bitmaps of 64 * lanes bits (set x lane): sample i flips the bit that (i, value) hashes to."""
    bit = mix(samples + np.arange(len(samples), dtype=np.uint64)[:, None] * np.uint64(0x2545F4914F6CDD1D)) % np.uint64(64 * lanes)
    out = np.zeros((samples.shape[1], lanes), np.uint64)
    for row in bit:
        np.bitwise_xor.at(out, (np.arange(len(out)), (row >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (row & np.uint64(63)))
    return out.view(np.int64)


def most_differing_bits(similarity: float, samples: int = ROWS * BANDS, bits: int = 64 * LANES, sigmas: float = 6) -> int:
    """The XOR population count that a pair of this similarity exceeds with about the chance of `sigmas` deviations."""
    differing = 2 * samples * (1 - similarity)
    spread_ = 2 * math.sqrt(samples * similarity * (1 - similarity))
    q = math.exp(-2 * differing / bits)
    noise = math.sqrt(bits * (1 - q * q) / 4)
    return min(bits, math.ceil(bits * (1 - q) / 2 + sigmas * math.hypot(spread_ * q, noise)))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, keys, s0...): node, keys and sketch are null for an empty set."""
    schema = "doc_id long, text_hash long, n_shingles long, node long, keys array<long>, " + ", ".join(f"{s} long" for s in SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = Hashes()
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                sets = [shingle_set(t.translate(LOWER).split(), words, hashes) for t in raw(some.column("text"))]
                full = np.flatnonzero([len(s) > 0 for s in sets])
                place = np.full(len(sets), -1)
                place[full] = np.arange(len(full))
                where = pa.array(np.where(place < 0, 0, place), mask=place < 0)
                if len(full):
                    samples = minhashes([sets[i] for i in full], ROWS * BANDS)
                    keys, sketch = band_keys(samples), odd_sketches(samples)
                    node = np.array([xxhash.xxh3_64_intdigest(sets[i].tobytes()) for i in full], np.uint64).view(np.int64)
                else:
                    keys, sketch, node = np.zeros((0, BANDS), np.int64), np.zeros((0, LANES), np.int64), np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
                cols = [pa.array(node), lists, *(pa.array(np.ascontiguousarray(c)) for c in sketch.T)]
                n = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text_hash"), n, *(c.take(where) for c in cols)], ["doc_id", "text_hash", "n_shingles", "node", "keys", *SKETCH])

    return spread(texts_of(docs, F.xxhash64("text").alias("text_hash"))).mapInArrow(run, schema)


def alike(a: str, b: str, percent: int) -> Column:
    """Whether the sketches and set sizes in the columns with prefixes a and b leave a similarity of percent / 100 possible."""
    differing = sum((F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in SKETCH[1:]), F.bit_count(F.col(f"{a}s0").bitwiseXOR(F.col(f"{b}s0"))))
    low, high = F.least(f"{a}n_shingles", f"{b}n_shingles"), F.greatest(f"{a}n_shingles", f"{b}n_shingles")
    return (low * 100 >= high * percent) & (differing <= most_differing_bits(percent / 100))


def with_texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """wanted with the text of one document of each node."""
    texts = texts_of(docs, F.xxhash64("text").alias("text_hash"))
    keyed = wanted.join(nodes.select("node", F.col("doc_id").alias("whose"), F.col("text_hash").alias("what")), "node")
    return keyed.join(texts, keyed.whose.eqNullSafe(texts.doc_id) & (keyed.what == texts.text_hash)).select(*[keyed[c] for c in wanted.columns], texts.text)


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int, chunk: int = 256) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union.

    Pairs are dealt by a; a node with many partners is dealt in chunks, each with its own copy of a's text.
    """
    of_a = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / chunk).alias("chunks"), F.count("*").alias("n")))
    pairs = joined(pairs, of_a, ["a"]).withColumn("salt", F.pmod(F.xxhash64("b"), "chunks"))
    wanted = pairs.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("member")).union(pairs.select(F.col("a").alias("node"), "a", "salt", F.lit(0)).distinct())
    dealt = with_texts(wanted, nodes, docs).repartition("a", "salt").sortWithinPartitions("a", "salt", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hub, base = Hashes(), None, None
        for batch in batches:
            a, b = [], []
            rows = (batch.column(c).to_pylist() for c in ("node", "a", "salt", "member"))
            for node, centre, salt, member, text in zip(*rows, raw(batch.column("text"))):
                if not member and hub == (centre, salt):
                    continue  # a repeated row
                own = shingle_set(text.translate(LOWER).split(), words, hashes)
                if not member:
                    hub, base = (centre, salt), own
                    continue
                both = len(np.intersect1d(base, own, assume_unique=True))
                if 100 * both >= percent * (len(base) + len(own) - both):
                    a.append(centre)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def joining_links(sets: list[np.ndarray], sketches: np.ndarray, component: np.ndarray, part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (row, row) that join all components that any similar pair joins; rows of equal parts only meet if all are equal."""
    size, component = np.array([len(s) for s in sets]), component.copy()
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    most, alone, links = most_differing_bits(percent / 100), len(np.unique(part)) == 1, []
    mark = np.zeros(len(values), bool)
    for i in range(len(sets)):
        others = (component != component[i]) & (alone | (part != part[i]))
        others[: i + 1] = False
        j = np.flatnonzero(others & (np.minimum(size, size[i]) * 100 >= percent * np.maximum(size, size[i])))
        j = j[np.bitwise_count(sketches[j] ^ sketches[i]).sum(1) <= most]
        if not len(j):
            continue
        own = flat[ends[i] - size[i] : ends[i]]
        mark[own] = True
        both = np.array([np.count_nonzero(mark[flat[ends[k] - size[k] : ends[k]]]) for k in j])
        mark[own] = False
        for k in j[100 * both >= percent * (size[i] + size[j] - both)]:
            if component[k] != component[i]:
                links.append((i, int(k)))
                component[component == component[k]] = component[i]
    return links


def may_meet(size: np.ndarray, sketches: np.ndarray, component: np.ndarray, part: np.ndarray, percent: int) -> np.ndarray:
    """For each row, whether sizes and sketches leave a similarity possible with a row of another component, as joining_links pairs them."""
    most, alone, out = most_differing_bits(percent / 100), len(np.unique(part)) == 1, np.zeros(len(size), bool)
    for i in range(len(size)):
        others = (component != component[i]) & (alone | (part != part[i]))
        others[: i + 1] = False
        j = np.flatnonzero(others & (np.minimum(size, size[i]) * 100 >= percent * np.maximum(size, size[i])))
        j = j[np.bitwise_count(sketches[j] ^ sketches[i]).sum(1) <= most]
        out[j] = True
        out[i] |= len(j) > 0
    return out


def possible(light: DataFrame, percent: int) -> DataFrame:
    """The rows of light (hub, low, high, node, component, part, n_shingles, s0...) that may be similar to one of their chunk pair."""
    columns = ["hub", "low", "high", "node", "component", "part", "n_shingles", *SKETCH]
    dealt = light.select(*columns).repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            size, component, part = (rows.column(c).to_numpy() for c in ("n_shingles", "component", "part"))
            sketches = np.stack([rows.column(s).to_numpy() for s in SKETCH], 1).view(np.uint64)
            return rows.filter(pa.array(may_meet(size, sketches, component, part, percent)))

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("hub", "low", "high")], 1)
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a < b:
                    if held and tuple(keys[a]) != group:
                        yield flush()
                        held = []
                    group = tuple(keys[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    return dealt.mapInArrow(run, dealt.schema)


def across(members: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int, chunk_rows: int = 1000, chunk_shingles: int = 500_000) -> DataFrame:
    """Links (a, b) that join the components of members (hub, node, component, main) of the same hub.

    A hub's members are cut into chunks of bounded rows and shingles, those of its main component apart from the
    others; every pair of chunks but those of two main ones meets in a task, with texts only where sketches call for it.
    """
    light = members.join(nodes.select("node", "n_shingles", *SKETCH), "node")
    needed = lambda of: F.coalesce(F.ceil(F.greatest(F.count_if(of) / chunk_rows, F.sum(F.when(of, F.col("n_shingles"))) / chunk_shingles)), F.lit(0))
    chunks = light.groupBy("hub").agg(needed(F.col("main")).alias("mains"), needed(~F.col("main")).alias("rest"), F.count("*").alias("n")).where("rest > 0")
    light = joined(light, stored(chunks), ["hub"]).withColumn("part", F.expr("IF(main, pmod(xxhash64(node), mains), mains + pmod(xxhash64(node), rest))"))
    light = light.withColumn("other", F.explode(F.expr("sequence(IF(main, mains, 0), mains + rest - 1)")))
    light = light.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("other", "mains", "rest", "main")
    dealt = with_texts(stored(possible(light, percent)), nodes, docs).repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, group, held = Hashes(), None, {}

        def flush() -> pa.RecordBatch:
            names = list(held)
            rows = list(held.values())
            links = joining_links([r[0] for r in rows], np.array([r[1] for r in rows], np.int64).view(np.uint64).reshape(-1, LANES), np.array([r[2] for r in rows]), np.array([r[3] for r in rows]), percent) if rows else []
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in links], pa.int64()), pa.array([names[j] for _, j in links], pa.int64())], ["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("hub", "low", "high")))
            sketches = np.stack([batch.column(s).to_numpy() for s in SKETCH], 1)
            rows = (batch.column(c).to_pylist() for c in ("node", "component", "part"))
            for key, sketch, node, component, part, text in zip(keys, sketches, *rows, raw(batch.column("text"))):
                if key != group:
                    yield flush()
                    group, held = key, {}
                if node not in held:
                    held[node] = (shingle_set(text.translate(LOWER).split(), words, hashes), sketch, component, part)
        yield flush()

    return dealt.mapInArrow(run, "a long, b long")


def compared(signed: DataFrame, docs: DataFrame, words: int, chunk: int = 256) -> DataFrame:
    """signed with nodes that hold equal sets only: rows whose set isn't that of their node's first row get another node.

    The rows of a node are dealt in chunks, each with its own copy of the first row's text.
    """
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min(name).alias("first"), F.count("*").alias("n")).where("n > 1")
    nodes = stored(nodes.withColumn("chunks", F.ceil(F.col("n") / chunk)))
    members = joined(signed.select("node", "doc_id", "text_hash"), nodes.select("node", "n", "first", "chunks"), ["node"]).distinct()
    members = members.select("node", "doc_id", "text_hash", F.pmod(F.xxhash64("doc_id", "text_hash"), "chunks").alias("salt"), F.lit(1).alias("member"))
    firsts = nodes.select("node", "first.doc_id", "first.text_hash", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("salt"), F.lit(0).alias("member"))
    wanted, texts = members.union(firsts), texts_of(docs, F.xxhash64("text").alias("text_hash"))
    met = wanted.join(texts.withColumnRenamed("doc_id", "whose").withColumnRenamed("text_hash", "what"), F.col("doc_id").eqNullSafe(F.col("whose")) & (F.col("text_hash") == F.col("what")))
    dealt = met.drop("whose", "what").repartition("node", "salt").sortWithinPartitions("node", "salt", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, group, base, own = Hashes(), None, b"", None
        for batch in batches:
            unlike = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("node", "salt", "member")), raw(batch.column("text")))
            for i, (node, salt, member, text) in enumerate(rows):
                if (node, salt) != group:
                    group, base, own = (node, salt), text, None
                elif member and text != base:
                    own = shingle_set(base.translate(LOWER).split(), words, hashes) if own is None else own
                    if not np.array_equal(own, shingle_set(text.translate(LOWER).split(), words, hashes)):
                        unlike.append(i)
            at = pa.array(unlike, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("doc_id", "text_hash", "node")], ["doc_id", "text_hash", "node"])

    unlike = stored(dealt.mapInArrow(run, "doc_id long, text_hash long, node long").distinct())
    if unlike.isEmpty():
        return signed
    kept = ["doc_id", "text_hash", "node"]
    other = unlike.select(F.col("doc_id").alias("u"), F.col("text_hash").alias("v"), F.col("node").alias("w"), F.lit(True).alias("unlike"))
    both = signed.join(other, F.col("doc_id").eqNullSafe(F.col("u")) & (F.col("text_hash") == F.col("v")) & (F.col("node") == F.col("w")), "left")
    node = F.when(F.col("unlike"), F.xxhash64("node", "text_hash", "doc_id")).otherwise(F.col("node"))
    return stored(both.withColumn("node", node).select(*kept, *[c for c in signed.columns if c not in kept]))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every document; linked are sets with similarity >= percent / 100."""
    signed = compared(stored(signatures(docs, words)), docs, words)
    nodes = stored(signed.where("node IS NOT NULL").dropDuplicates(["node"]))
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    hubs = stored(keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("n")).where("hub < last").select("key", "hub", "n"))
    shared = stored(joined(keyed, hubs, ["key"]))
    light = nodes.select("node", "n_shingles", *SKETCH)

    stars = shared.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    centres = stored(light.join(stars.select(F.col("a").alias("node")).groupBy("node").agg(F.count("*").alias("n")), "node"))
    x = centres.select("n", *[F.col(c).alias(f"x_{c}") for c in light.columns])
    met = joined(stars, x.withColumnRenamed("x_node", "a"), ["a"]).join(light.withColumnRenamed("node", "b"), "b")
    stars = stored(met.where(alike("x_", "", percent)).select("a", "b"))
    links = stored(confirmed(stars, nodes, docs, words, percent))
    found = components(links)

    labelled = stored(shared.where("hub <> node").join(found, "node", "left").select("key", "hub", "node", F.coalesce("component", "node").alias("component")))
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low < high").select("key", "n")
    of_hub = found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    members = stored(joined(labelled, stored(open_keys), ["key"]).select("hub", "node", "component").distinct())
    hubs = members.groupBy("hub").agg(F.count("*").alias("n")).join(of_hub, "hub", "left").withColumn("hub_component", F.coalesce("hub_component", "hub"))
    members = stored(joined(members, stored(hubs), ["hub"]).select("hub", "node", "component", (F.col("component") == F.col("hub_component")).alias("main")))
    more = stored(across(members, nodes, docs, words, percent))
    if not more.isEmpty():
        found = components(links.union(more))

    named = stored(nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    per_node = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("smallest"), F.count("*").alias("n"))
    names = named.join(per_node, "node")
    least = names.groupBy("component").agg(F.min("smallest").alias("component_id"), F.count("*").alias("n"))
    of_node = joined(names.withColumnRenamed("n", "rows"), stored(least), ["component"]).select("node", "component_id", F.col("rows").alias("n"))
    columns = ["doc_id", "text_hash", "n_shingles"]
    out = joined(signed.select(*columns, "node"), stored(of_node), ["node"]).select(*columns, "component_id")
    out = out.unionByName(signed.where("node IS NULL").select(*columns, F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def sql(percent: int = 80) -> str:
    """The same for shingles of two words in DuckDB's SQL over the table `documents`: all pairs that share a shingle are counted."""
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, {LOWER_SQL} AS w FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle FROM w),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
 HAVING 100 * count(*) >= {percent} * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))),
 reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
 SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)"""
