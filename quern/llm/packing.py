"""Cost-balanced packing of tokenized documents into fixed-length training sequences.

Each scan partition is packed on its own, in blocks of a bounded number of tokens, so nothing is shuffled and a lost
task repeats only its own block. In a block, documents are cut into full sequences first; the remainders, longest
first, go to the sequence with the lowest estimated attention cost (linear + quadratic) that still has room for them.
A remainder that fits nowhere whole is cut over the cheapest sequences with room. As many sequences are opened as
the tokens fill; what is left over at the end of a block goes to sequences whose lengths are powers of two, which
need no padding.

Defined cases: null text counts as empty (a document of the end id alone); a null doc_id is kept; repeated rows are
packed like any other; ties go to the earlier row and the lower sequence; an empty table gives no rows; other columns
of the table are ignored.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quern.llm.bpe import Merges
from quern.llm.common import slices, texts_of, tidy
from quern.scratch import spread

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of texts by a tokenizer whose tokens never cross a space, found once for each distinct stretch.

    Stretches of ASCII and Latin-1 letters, on which normalising is plain lower-casing, are merged as arrays; the
    tokenizer itself encodes every other one.
    """

    PLAIN = re.compile("[!-;=-~\\nÀ-ÖØ-öø-ÿ]*")
    CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")

    def __init__(self, path: str, end_id: int, most: int = 400_000, longest: int = 200):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.merges = Tokenizer.from_file(path), Merges(path)
        self.end, self.most, self.longest = np.array([end_id], "<u4").tobytes(), most, longest
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [t.split(" ") for t in texts]
        if new := list(set().union(*parts).difference(self.known)):
            plain, other = [], []
            for chunk in new:
                (plain if self.PLAIN.fullmatch(chunk) else other).append(chunk)
            cut = [self.CUT.findall(c.lower()) for c in plain]
            distinct = list(set().union(*cut)) if cut else []
            symbols, counts = self.merges.merge([x.encode() for x in distinct])
            flat, ends = symbols.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            ids = dict(zip(distinct, [flat[a:b] for a, b in zip([0, *ends], ends)]))
            self.known.update((c, ids[p[0]] if len(p) == 1 else b"".join(map(ids.__getitem__, p))) for c, p in zip(plain, cut))
            for chunk, got in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
                self.known[chunk] = np.array(got.ids, "<u4").tobytes()
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, p)) + self.end, "<u4") for p in parts]
        for chunk in [c for c in new if len(c) > self.longest]:
            del self.known[chunk]
        if len(self.known) > self.most:
            self.known.clear()
        return out


def pack(lengths: np.ndarray, capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 1024) -> tuple[np.ndarray, ...]:
    """Pieces (document, start, length, sequence, offset) that cover every token of every document once."""
    lengths = np.asarray(lengths, np.int64)
    whole, rest = lengths // capacity, lengths % capacity
    doc = np.repeat(np.arange(len(lengths)), whole)
    step = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    pieces = [(d, s * capacity, capacity, i, 0) for i, (d, s) in enumerate(zip(doc.tolist(), step.tolist()))]
    total = int(rest.sum())
    tail = [1 << k for k in range(capacity.bit_length()) if total % capacity >> k & 1]
    size = np.array([capacity] * (total // capacity) + tail[::-1], np.int64)
    room, cost, first = size.copy(), np.zeros(len(size)), len(pieces)
    for d in np.argsort(-rest, kind="stable"):
        left = int(rest[d])
        while left:
            fits = room >= left
            j = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            put = min(left, int(room[j]))
            pieces.append((int(d), int(lengths[d]) - left, put, first + j, int(size[j] - room[j])))
            room[j] -= put
            cost[j] += linear * put + quadratic * put * put
            left -= put
    return tuple(np.array(pieces, np.int64).reshape(-1, 5).T)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 1024, block_tokens: int = 2_000_000) -> DataFrame:
    """One row per piece: where it starts in its document, the sequence it went to and its place there.

    tokenizer: path of a tokenizers .json file whose tokens don't cross spaces. capacity: a power of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = WordEncoder(tokenizer, end_id), TaskContext.get()
        state = {"next": (task.partitionId() if task else 0) << 32, "ids": [], "docs": [], "held": 0}

        def flush() -> pa.RecordBatch:
            ids, names = state["ids"], state["docs"]
            lengths = np.array([len(x) for x in ids], np.int64)
            doc, start, length, sequence, offset = pack(lengths, capacity, linear, quadratic)
            crc = [zlib.crc32(ids[d][s : s + n]) for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            first = state["next"]
            state.update(next=first + (int(sequence.max()) + 1 if len(sequence) else 0), ids=[], docs=[], held=0)
            whose = pa.array([names[d] for d in doc.tolist()], pa.int64())
            cols = [whose, start, length, pa.array(crc, pa.int64()), lengths[doc], sequence + first, offset]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for some in slices(batch, "text"):
                for name, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text").to_pylist())):
                    state["ids"].append(ids)
                    state["docs"].append(name)
                    state["held"] += len(ids)
                    if state["held"] >= block_tokens:
                        yield flush()
        if state["ids"]:
            yield flush()

    return spread(texts_of(docs)).mapInArrow(tidy(run), SCHEMA)
