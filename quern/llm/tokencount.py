"""Token counts under a byte-level BPE vocabulary by rank-synchronous array merging.

Texts are cut into pre-tokens; a batch's distinct pre-tokens lie one after another in one ragged symbol array. Each
round looks up the merge rank of every adjacent pair at once, finds each pre-token's lowest rank, and merges all
places with that rank in all pre-tokens simultaneously (overlapping places of a doubled symbol from the left). A
pre-token without a mergeable pair is finished; its count is the number of symbols left.

Defined cases: null and empty texts have 0 bytes and 0 tokens; a null doc_id is kept; repeated rows are counted each;
texts of any length are counted whole; an empty table gives no rows; other columns are ignored.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from quern.llm.bpe import Merges
from quern.llm.common import slices, texts_of
from quern.scratch import spread

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """Token counts of texts; remembers the counts of stretches between single spaces while a task runs."""

    def __init__(self, path: str, pattern: str, most: int = 400_000):
        import re

        import regex

        self.merges, self.cut, self.most = Merges(path), regex.compile(pattern), most
        self.special = re.compile("|".join(map(re.escape, self.merges.special))) if self.merges.special else None
        self.uneven = regex.compile(r" (?!\S)")
        self.known: dict[str, int] = {}

    def stretches(self, text: str) -> list[str]:
        """Pieces that no pre-token crosses. A space before a visible character always begins a pre-token."""
        if self.uneven.search(text):
            return self.cut.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def count(self, texts: list[str]) -> list[int]:
        extra = [0] * len(texts)
        parts = []
        for i, text in enumerate(texts):
            if self.special and (found := len(self.special.findall(text))):
                extra[i] = found
                parts.append([x for t in self.special.split(text) for x in self.stretches(t)])
            else:
                parts.append(self.stretches(text))
        new = list(set().union(*parts).difference(self.known))
        cut = [self.cut.findall(x) for x in new]
        distinct = list(set().union(*cut)) if cut else []
        sizes = dict(zip(distinct, self.merges.merge([x.encode() for x in distinct], symbols=False)[1].tolist()))
        self.known.update((x, sum(map(sizes.__getitem__, c))) for x, c in zip(new, cut))
        out = [n + sum(map(self.known.__getitem__, p)) for n, p in zip(extra, parts)]
        if len(self.known) > self.most:
            self.known.clear()
        return out


def count_tokens(docs: DataFrame, tokenizer: str, pattern: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text. tokenizer: a byte-level BPE .json; pattern: its pre-token pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer, pattern)
        for batch in batches:
            for some in slices(batch, "text"):
                n = pa.array(counter.count(some.column("text").to_pylist()), pa.int64())
                size = pa.compute.cast(pa.compute.binary_length(some.column("text")), pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), size, n, pa.compute.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return spread(texts_of(docs)).mapInArrow(run, SCHEMA)
