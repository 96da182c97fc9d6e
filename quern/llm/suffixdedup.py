"""Exact removal of long byte strings that an earlier document holds as well.

A byte goes if it is covered by a string of `least` bytes that also starts in a document with a smaller doc_id.

1. Consecutive windows of `least` bytes with the same minimum hash of their k-byte strings form a run; the minimum is
   its mark. Equal windows have equal marks wherever they stand, and the place of the minimum has the same neighbouring
   bytes on the left or on the right, for at least half of what the window has besides. Marks with short hashes of both
   sides are dealt out in packed arrays, and each document learns which of its marks another document has with an
   equal side.
2. Only runs with such marks travel, as the bytes their windows cover, dealt by mark, so equal windows meet. Equal
   fragments are merged first, with their smallest doc_id; a fragment thousands of documents share is compared once.
3. Fragments of one mark that differ are compared by interval expansion on their Burrows-Wheeler transform (suffixes),
   which groups all windows with equal bytes; a group's smallest doc_id decides which occurrences go.
4. The ranges found return to their documents, as the marks of step 1 do: a bucket sends one packed row to each shard of
   documents, a shard one row for each document, so rows don't multiply with the buckets that a document has a part in.

Texts are read in segments, buckets grow in number with the input, and a bucket's fragments are compared in blocks of
marks. What many documents share is collapsed where it is read, for every 16 MB of text: of equal marks with an equal
side only the smallest and largest doc travel to the meeting, of equal fragments only the smallest doc. The other
documents' marks and ranges go straight on. A mark's part of a bucket thus grows with the fragments around it that
differ, and with the number of 16 MB portions, but not with the documents.

Defined cases: null and empty texts are empty; texts shorter than `least` lose nothing; of equal texts the one with the
smallest doc_id stays whole; rows that repeat doc_id and text are one document and lose nothing to each other; if a
doc_id has unlike texts (of 4 GB together at most), each loses what its own bytes repeat of smaller doc_ids; a row with a null doc_id has no order, so it loses
nothing and removes nothing; empty tables give no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import mix, raw, slices, texts_of
from quern.llm.suffixes import prefix_groups, spread_ranges
from quern.scratch import small, spread, stored

NO_ID = -(2**63)
SEGMENT = 1 << 20
FACTOR = 0x9E3779B97F4A7C15
BYTE = np.random.default_rng(5).integers(0, 2**63, 256, np.uint64)


def string_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes at every place that has so many left."""
    powers = {1: (BYTE[data], FACTOR)}
    have, value = 0, None
    bit = 1
    while bit <= k:
        h, f = powers[bit]
        if k & bit:
            if value is None:
                have, value = bit, h
            else:  # the strings so far, then the next `bit` bytes
                tail = h[have:]
                value = value[: len(tail)] * np.uint64(f) + tail[: len(value)]
                have += bit
        powers[2 * bit] = (h[:-bit] * np.uint64(f) + h[bit:] if len(h) > bit else h[:0], f * f % 2**64)
        bit *= 2
    return mix(value)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of every `width` neighbours."""
    span = 1
    while span < width:
        s = min(span, width - span)
        values = best(values[:-s], values[s:])
        span += s
    return values


def mark_of(minimum: np.ndarray) -> np.ndarray:
    """48 bits; equal marks of unlike windows only cost a comparison."""
    return mix(minimum) >> np.uint64(16)


def tag_of(mark: np.ndarray, buckets: int) -> np.ndarray:
    """A mark's bucket and 32 bits of the rest."""
    return (mark % np.uint64(buckets)) << np.uint64(32) | mark // np.uint64(buckets) & np.uint64(2**32 - 1)


def pieces(texts: list[bytes], least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bounded groups of text segments: bytes, and of each segment its text's number, place in it, start and size here.

    Segments overlap by `least` - 1 bytes, so every window of a text lies in exactly one.
    """
    parts = [(i, at, t[at : at + SEGMENT + least - 1]) for i, t in enumerate(texts) for at in range(0, len(t) - least + 1, SEGMENT)]
    while parts:
        n, total = 0, 0
        while n < len(parts) and (not n or total + len(parts[n][2]) <= 2 * SEGMENT):
            total += len(parts[n][2])
            n += 1
        some, parts = parts[:n], parts[n:]
        size = np.array([len(p[2]) for p in some])
        yield np.frombuffer(b"".join(p[2] for p in some), np.uint8), np.array([p[0] for p in some]), np.array([p[1] for p in some]), np.cumsum(size) - size, size


def minima(data: np.ndarray, size: np.ndarray, least: int, k: int) -> tuple[np.ndarray, ...]:
    """Hash of the k bytes at every place, the minimum of every window, whether the window lies in one segment, and the
    segment of every byte."""
    hashes = string_hashes(data, k)
    window = sliding(hashes, least - k + 1, np.minimum)
    part = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return hashes, window, part[: len(window)] == part[least - 1 :], part


def marked_places(texts: list[bytes], least: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, mark, hash of the bytes before, hash of the bytes after) of every place that is a window's minimum."""
    side = (least - k) // 2
    for data, text, _, start, size in pieces(texts, least):
        hashes, window, whole, part = minima(data, size, least, k)
        room = np.zeros(least - k, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate([room, np.where(whole, window, 0), room]), least - k + 1, np.maximum) == hashes)
        own = part[at]
        sides = (string_hashes(data, side) >> np.uint64(56)).astype(np.uint8)
        before = np.where(at - side >= start[own], sides[np.maximum(at - side, 0)], 0)
        after = np.where(at + k + side <= (start + size)[own], sides[np.minimum(at + k, len(sides) - 1)], 0)
        yield text[own], mark_of(hashes[at]), before, after, data


def runs(texts: list[bytes], least: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first window, windows, mark) of every run, with the bytes at hand and the run's place in them."""
    for data, text, offset, start, size in pieces(texts, least):
        _, window, whole, part = minima(data, size, least, k)
        first = whole & np.r_[True, (window[1:] != window[:-1]) | (part[1 : len(window)] != part[: len(window) - 1])]
        at = np.flatnonzero(first)
        own = part[at]
        stop = np.minimum(np.append(at[1:], len(window)), (start + size - least + 1)[own])
        yield text[own], at - start[own] + offset[own], stop - at, mark_of(window[at]), data, at


def short(values: np.ndarray) -> np.ndarray:
    """48-bit values as rows of six bytes."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary rows: the bytes of counts[i] values each."""
    ends = np.concatenate([[0], np.cumsum(counts) * (values.nbytes // max(1, len(values)))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())


def several(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each row, whether its key occurs with more than one doc."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    owner = docs[order]
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts), np.diff(np.append(starts, len(keys))))
    return out


def ends_of_groups(docs: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For each row, whether it stands for the smallest or the largest doc of the rows with its keys."""
    order = np.lexsort((docs, *keys))
    edge = np.flatnonzero(np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))
    out = np.zeros(len(docs), bool)
    out[order[np.r_[0, edge + 1]]] = out[order[np.r_[edge, len(docs) - 1]]] = True
    return out


def by_doc(doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct docs in order, how many rows each has, and the values in that order."""
    order = np.lexsort((*reversed(values), doc))
    doc = doc[order]
    row = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    return doc[row], np.diff(np.append(row, len(doc))), [v[order] for v in values]


def for_shards(names: np.ndarray, n: np.ndarray, pairs: np.ndarray, shards: int) -> pa.Table:
    """Packed rows, one for each shard of documents, of pairs of 32-bit numbers: n of them for each of the names."""
    shard = (mix(names.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    pairs = pairs[spread_ranges((np.cumsum(n) - n)[order], n[order])]
    names, n, shard = names[order], n[order], shard[order]
    row = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(names) else np.zeros(0, np.int64)
    docs, size = np.diff(np.append(row, len(names))), np.add.reduceat(n, row) if len(row) else row
    return pa.table({"shard": shard[row], "docs": packed(names, docs), "counts": packed(n.astype(np.uint32), docs), "first": packed(pairs[:, 0], size), "second": packed(pairs[:, 1], size)})


def gathered(met: DataFrame, name: str) -> DataFrame:
    """(key, name): all pairs of a document, in one row; from the rows of for_shards."""

    def gather(table: pa.Table) -> pa.Table:
        docs, counts, first, second = (b"".join(table.column(c).to_pylist()) for c in ("docs", "counts", "first", "second"))
        doc = np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32))
        order = np.argsort(doc, kind="stable")
        doc, pairs = doc[order], np.stack([np.frombuffer(first, np.uint32), np.frombuffer(second, np.uint32)], 1)[order]
        row = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        return pa.table({"key": doc[row], name: packed(pairs, np.diff(np.append(row, len(doc))))})

    return met.groupBy("shard").applyInArrow(gather, f"key long, {name} binary")


PAIRS = "shard long, docs binary, counts binary, first binary, second binary"


def shared_marks(docs: DataFrame, least: int, k: int, buckets: int, shards: int = 1) -> DataFrame:
    """(key, tags): tags of a document's marks that another document has with an equal side, one row a document."""

    def emit(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, mark, before, after = (np.concatenate(x) for x in zip(*held))
        tag = tag_of(mark, buckets)
        bucket = (tag >> np.uint64(32)).astype(np.int64)
        entry = tag << np.uint64(32) >> np.uint64(16) | before.astype(np.uint64) << np.uint64(8) | after.astype(np.uint64)
        order = np.lexsort((entry, doc, bucket))
        doc, entry, bucket = doc[order], entry[order], bucket[order]
        new = np.r_[True, (entry[1:] != entry[:-1]) | (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])]
        doc, entry, bucket = doc[new], entry[new], bucket[new]
        # Of entries that share a mark and a side here, the smallest and largest doc stand for all: the others are known
        # to have company, so their marks pass the meeting by, in buckets below zero.
        mark = entry >> np.uint64(16)
        sent = ends_of_groups(doc, entry >> np.uint64(8), bucket) | ends_of_groups(doc, mark << np.uint64(8) | entry & np.uint64(255), bucket)
        names, n_known, (known,) = by_doc(doc[~sent], mark[~sent] * np.uint64(buckets) + bucket[~sent].astype(np.uint64))
        doc, entry, bucket = doc[sent], entry[sent], bucket[sent]
        row = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        own = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])])
        of_row = np.diff(np.append(np.searchsorted(own, row), len(own)))
        counts = np.diff(np.append(own, len(doc))).astype(np.uint32)
        columns = ["bucket", "docs", "counts", "entries"]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[row]), packed(doc[own], of_row), packed(counts, of_row), packed(short(entry), np.diff(np.append(row, len(entry))))], columns)
        if len(names):
            one = np.array([len(names)])
            aside = -1 - int(names[0]) % buckets
            yield pa.RecordBatch.from_arrays([pa.array([aside]), packed(names, one), packed(n_known.astype(np.uint32), one), packed(short(known), np.array([len(known)]))], columns)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for some in slices(batch, "text"):
                names = some.column("key").to_numpy()
                for text, mark, before, after, data in marked_places(raw(some.column("text")), least, k):
                    if len(mark):
                        held.append((names[text], mark, before, after))
                    size += len(data)
                    if size > 16 << 20 and held:
                        yield from emit(held)
                        held, size = [], 0
        if held:
            yield from emit(held)

    def meet(table: pa.Table) -> pa.Table:
        docs, counts, entries = (b"".join(table.column(c).to_pylist()) for c in ("docs", "counts", "entries"))
        doc, entry = np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32)), unpacked(entries)
        if table.column("bucket")[0].as_py() < 0:
            names, n, (tags,) = by_doc(doc, tag_of(entry, buckets))
            return for_shards(names, n, tags.view(np.uint32).reshape(-1, 2), shards)
        mark = entry >> np.uint64(16)
        hot = several(entry >> np.uint64(8), doc) | several(mark << np.uint64(8) | entry & np.uint64(255), doc)
        doc, tag = doc[hot], mark[hot] | np.uint64(table.column("bucket")[0].as_py() << 32)
        order = np.lexsort((tag, doc))
        doc, tag = doc[order], tag[order]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])][: len(doc)]
        names, n, (tags,) = by_doc(doc[new], tag[new])
        return for_shards(names, n, tags.view(np.uint32).reshape(-1, 2), shards)

    dealt = docs.mapInArrow(deal, "bucket long, docs binary, counts binary, entries binary")
    return gathered(dealt.groupBy("bucket").applyInArrow(meet, PAIRS), "tags")


def smallest_docs(fragments: list[bytes], marks: np.ndarray, docs: np.ndarray, least: int, block: int = 2 << 20) -> tuple[np.ndarray, np.ndarray]:
    """For distinct fragments with their smallest doc: the smallest doc of every window, and where each fragment's begin."""
    size = np.array([len(f) for f in fragments])
    windows = size - least + 1
    begin = np.cumsum(windows) - windows
    found = np.repeat(docs, windows)
    order = np.argsort(marks, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(marks[order]) != 0])
    counts = np.diff(np.append(starts, len(order)))
    pending, held = [], 0
    for s, n in [*zip(starts.tolist(), counts.tolist()), (0, 0)]:
        if n > 1:  # a mark's only fragment has no other to be compared with
            pending.extend(order[s : s + n].tolist())
            held += int(size[order[s : s + n]].sum())
        if pending and (not n or held > block):
            some = np.array(pending)
            place, group = prefix_groups(np.frombuffer(b"".join(fragments[i] for i in pending), np.uint8), size[some], least)
            base = np.cumsum(size[some]) - size[some]
            which = np.searchsorted(base, place, side="right") - 1
            low = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(low, group, docs[some[which]])
            found[begin[some[which]] + place - base[which]] = low[group]
            pending, held = [], 0
    return found, begin


def repeated_ranges(texts: DataFrame, least: int, k: int, mark_buckets: int, buckets: int, shards: int = 1) -> DataFrame:
    """(key, spans): window ranges (first, last + 1) that a document loses, one row a document, from texts (key, text, tags)."""

    def emit(known: dict[bytes, int], marks: list[int], held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, place, which = (np.concatenate(x) for x in zip(*held))
        fragments, mark = list(known), np.array(marks, np.uint64)
        # Only a fragment's smallest doc here can keep it; in the others all its windows go, without meeting any more.
        low = np.full(len(fragments), np.iinfo(np.int64).max)
        np.minimum.at(low, which, doc)
        lost = doc > low[which]
        windows = np.array([len(f) for f in fragments]) - least + 1
        names, n_lost, (begin, stop) = by_doc(doc[lost], place[lost], place[lost] + windows[which[lost]])
        doc, place, which = doc[~lost], place[~lost], which[~lost]
        bucket = (mark % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        row = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
        distinct = np.diff(np.append(row, len(order)))
        nth = np.empty(len(order), np.int64)  # of a fragment in its row
        nth[order] = np.arange(len(order)) - np.repeat(row, distinct)
        size = np.array([len(fragments[i]) for i in order])
        by_row = np.argsort(bucket[which], kind="stable")
        n = np.bincount(np.searchsorted(bucket[order][row], bucket[which]), minlength=len(row))
        content = np.frombuffer(b"".join(fragments[i] for i in order), np.uint8)
        columns = ["bucket", "docs", "places", "which", "sizes", "marks", "content"]
        if len(names):
            one, none = np.array([len(begin)]), pa.array([b""], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([-1 - int(names[0]) % buckets]), packed(np.repeat(names, n_lost), one), packed(begin.astype(np.uint32), one), packed(stop.astype(np.uint32), one), none, none, none], columns)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[order][row]), packed(doc[by_row], n), packed(place[by_row].astype(np.uint32), n), packed(nth[which[by_row]].astype(np.uint32), n), packed(size.astype(np.uint32), distinct), packed(short(mark[order]), distinct), packed(content, np.add.reduceat(size, row))],
            columns,
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        marks, held, size = [], [], 0
        for batch in batches:
            for some in slices(batch, "text"):
                names = some.column("key").to_numpy()
                base = some.column("base").to_numpy()
                tags = [np.frombuffer(row, np.uint64) for row in some.column("tags").to_pylist()]
                whose = np.repeat(np.arange(len(tags), dtype=np.uint64), [len(t) for t in tags])
                hot = np.unique(mix(np.concatenate(tags) ^ mix(whose + np.uint64(1))))
                for text, place, windows, mark, data, at in runs(raw(some.column("text")), least, k):
                    own = mix(tag_of(mark, mark_buckets) ^ mix(text.astype(np.uint64) + np.uint64(1)))
                    pick = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, own), len(hot) - 1)] == own)
                    if not len(pick):
                        continue
                    content, which = data.tobytes(), np.empty(len(pick), np.int64)
                    stops = at[pick] + windows[pick] + least - 1
                    for i, (a, b, m) in enumerate(zip(at[pick].tolist(), stops.tolist(), mark[pick].tolist())):
                        fragment = content[a:b]
                        if (n := known.setdefault(fragment, len(known))) == len(marks):
                            marks.append(m)
                            size += len(fragment)
                        which[i] = n
                    held.append((names[text[pick]], place[pick] + base[text[pick]], which))
                    if size > 16 << 20:
                        yield from emit(known, marks, held)
                        known, marks, held, size = {}, [], [], 0
        if held:
            yield from emit(known, marks, held)

    def meet(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            docs, begin, stop = (b"".join(table.column(c).to_pylist()) for c in ("docs", "places", "which"))
            names, n, spans = by_doc(np.frombuffer(docs, np.int64), np.frombuffer(begin, np.uint32), np.frombuffer(stop, np.uint32))
            return for_shards(names, n, np.stack(spans, 1), shards)
        rows = [table.column(c).to_pylist() for c in ("docs", "places", "which", "sizes", "marks", "content")]
        doc, place, size = (np.frombuffer(b"".join(rows[i]), t).astype(np.int64) for i, t in ((0, np.int64), (1, np.uint32), (3, np.uint32)))
        mark, content, ends = unpacked(b"".join(rows[4])).astype(np.int64), b"".join(rows[5]), np.cumsum(size)
        first = np.cumsum([0, *(len(x) // 4 for x in rows[3])])  # a row numbers its own fragments
        sent = np.concatenate([np.frombuffer(x, np.uint32) + f for x, f in zip(rows[2], first)])
        known: dict[bytes, int] = {}
        same = np.array([known.setdefault(content[a:b], len(known)) for a, b in zip((ends - size).tolist(), ends.tolist())])
        which, mark_of, size = same[sent], mark, size[sent]
        low, marks = np.full(len(known), np.iinfo(np.int64).max), np.zeros(len(known), np.int64)
        np.minimum.at(low, which, doc)
        marks[same] = mark_of
        found, begin = smallest_docs(list(known), marks, low, least)
        windows = size - least + 1
        out = []
        step = max(1, int((4 << 20) // max(1, windows.mean())))
        for s in range(0, len(doc), step):
            w = windows[s : s + step]
            owner, gone = np.repeat(np.arange(s, s + len(w)), w), found[spread_ranges(begin[which[s : s + step]], w)] < np.repeat(doc[s : s + step], w)
            at = np.repeat(place[s : s + step] - np.cumsum(w) + w, w) + np.arange(len(gone))
            opens = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | (owner[1:] != owner[:-1])])
            closes = np.flatnonzero(gone & np.r_[~gone[1:] | (owner[1:] != owner[:-1]), True])
            out.append((doc[owner[opens]], np.stack([at[opens], at[closes] + 1], 1).astype(np.uint32)))
        doc, spans = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(doc, kind="stable")
        doc, spans = doc[order], spans[order]
        row = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
        return for_shards(doc[row], np.diff(np.append(row, len(doc))), spans, shards)

    dealt = texts.mapInArrow(deal, "bucket long, docs binary, places binary, which binary, sizes binary, marks binary, content binary")
    return gathered(dealt.groupBy("bucket").applyInArrow(meet, PAIRS), "spans")


def placed(texts: DataFrame, unlike: DataFrame) -> DataFrame:
    """texts with `base`: where a text begins if the unlike texts of its doc_id stand one after another, in order of their hashes."""
    keys = small(stored(unlike))
    shared = texts.join(keys, "key", "left_semi").select("key", F.xxhash64("text").alias("hash"), F.octet_length("text").cast("long").alias("n")).distinct()
    before = Window.partitionBy("key").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(shared.select("key", "hash", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    found = texts.withColumn("hash", F.xxhash64("text")).join(small(bases), ["key", "hash"], "left")
    return found.select("key", "text", F.coalesce("base", F.lit(0)).cast("long").alias("base"))


def cut_repeats(docs: DataFrame, least: int = 50, k: int = 14, bucket_bytes: int = 4 << 20, fragment_bytes: int = 4 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, text): text is what is left, as bytes.

    bucket_bytes, fragment_bytes: text per bucket in which marks meet, and in which fragments meet; shard_bytes: text per
    shard of documents to which what they found returns.
    """
    texts = texts_of(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "text")
    known = texts.select("key", F.octet_length("text").alias("n"), F.xxhash64("text").alias("hash")).groupBy("key").agg(F.sum("n").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    unlike = (F.col("key") != NO_ID) & (F.col("low") != F.col("high"))
    total, n_unlike = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(unlike)).first()
    texts = placed(texts, known.where(unlike).select("key")) if n_unlike else texts.withColumn("base", F.lit(0).cast("long"))
    mark_buckets, shards = 1 + total // bucket_bytes, 1 + total // shard_bytes
    # Rows without an id lose nothing; they don't meet under a common key. Both joins share one exchange of the others.
    named, unnamed = texts.where(F.col("key") != NO_ID), texts.where(F.col("key") == NO_ID)
    hot = shared_marks(spread(named), least, k, mark_buckets, shards)
    ranges = repeated_ranges(named.join(hot, "key"), least, k, mark_buckets, 1 + total // fragment_bytes, shards)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                n, removed, count, left = [], [], [], []
                for text, base, spans in zip(raw(some.column("text")), some.column("base").to_pylist(), some.column("spans").to_pylist()):
                    kept, at, spots = [], 0, 0
                    ranges = np.frombuffer(spans or b"", np.uint32).reshape(-1, 2).astype(np.int64) - base
                    ranges = ranges[(ranges[:, 0] >= 0) & (ranges[:, 0] <= len(text) - least)]  # not those of the doc_id's other texts
                    if len(ranges):
                        ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
                        stops = np.minimum(np.maximum.accumulate(ranges[:, 1] + least - 1), len(text))
                        opens = np.flatnonzero(np.r_[True, ranges[1:, 0] > stops[:-1]])
                        for a, b in zip(ranges[opens, 0].tolist(), stops[np.append(opens[1:] - 1, len(ranges) - 1)].tolist()):
                            kept.append(text[at:a])
                            spots += a < b
                            at = max(at, b)
                    rest = b"".join(kept) + text[at:]
                    n.append(len(text))
                    removed.append(len(text) - len(rest))
                    count.append(spots)
                    left.append(rest)
                key = some.column("key")
                ids = pa.compute.if_else(pa.compute.equal(key, NO_ID), pa.scalar(None, pa.int64()), key)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(left, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "text"])

    spans = F.lit(None).cast("binary").alias("spans")
    return named.join(ranges, "key", "left").select("key", "text", "base", "spans").union(unnamed.select("key", "text", "base", spans)).mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, text binary")
