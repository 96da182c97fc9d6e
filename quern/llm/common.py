"""Small helpers that the training-data operators share."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lower-cases A-Z and leaves every other byte; bytes.split() then cuts at 0x20 and 0x09-0x0D.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower-cases A-Z and turns every ASCII byte that is neither letter nor digit into a space.
ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER)

#: The words of a text in DuckDB's SQL, of letters and digits and of anything but white space, with A-Z lower-cased.
WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"
ALNUM_SQL, LOWER_SQL = WORDS_SQL.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), WORDS_SQL.format(r"[^\x20\x09-\x0D]+")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo divisor (null for a null key)."""
    return F.crc32(F.col(key).cast("string")) % divisor


def texts_of(docs: DataFrame, *extra) -> DataFrame:
    """(doc_id, text, extra...) with null texts as empty ones; whatever else the table holds is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)


#: The columns that name a row: its doc_id, or its text's hash if that is null.
ROW = ["key", "unnamed"]


def named_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, key, unnamed, text) as texts_of; rows of one name have one doc_id, or none and one text."""
    return texts_of(docs).select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("key"), F.col("doc_id").isNull().alias("unnamed"), "text")


def raw(column: pa.Array) -> list:
    """The strings of an Arrow column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: str, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `budget` bytes in `column`, so that long texts don't pile up."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // budget
    for at in (cuts := np.flatnonzero(np.diff(group, prepend=-1, append=-2)))[:-1]:
        yield batch.slice(at, cuts[np.searchsorted(cuts, at) + 1] - at)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives Arrow's unused memory back when a task ends: Spark keeps its Python workers for later tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def word_hash(word: bytes) -> int:
    """A 64-bit hash of a word, as a Python int below 2**64."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


class Hashes(dict):
    """word -> 64-bit hash, filled on demand; cleared when it has grown past `most` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = word_hash(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words, from the words' hashes; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = mix(out + hashes[j : j + n])
    return out


def shingle_set(words: list[bytes], size: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a text of fewer words has one, of no word none."""
    return np.unique(gram_hashes(hashes.of(words), min(size, len(words)))) if words else np.zeros(0, np.uint64)
