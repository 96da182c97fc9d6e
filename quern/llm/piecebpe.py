"""SentencePiece BPE encoding and decoding by a table of prefixes.

Every prefix of a text has one BPE encoding, and the encoding of a prefix that ends between two tokens of the text's own
encoding is the head of it. So one number for each prefix, the length of its last token, holds the encoding of them all.
The table is filled from left to right: an automaton lists the pieces that end at a place; a piece is the last token
if merging its own characters gives it whole and it is compatible with the last token of the prefix before it, that is,
if merging the characters of both together leaves the two apart. One piece at most can be, and where none is, the
character stands alone. The ids are recovered backwards from the text's end.

No piece crosses a place between two characters that are neighbours in no piece, so tables are made for the parts
between such places, and the ids of parts that occur again are remembered. In vocabularies that were split at white
space, every run of space marks begins a stretch of parts, remembered too. Characters without a piece become the ids of their UTF-8 bytes.

Only models of this kind are taken: BPE, byte pieces for every byte, no character normalisation, a space mark put before
the text, no white space removed; others raise ValueError.

Defined cases: null and empty texts have no ids and decode to the empty text; a null doc_id is kept; repeated rows are
encoded each; the names of control pieces are ordinary text; texts of any length are encoded whole, in time linear in
their length; an empty table gives no rows; other columns are ignored.
"""

import array
import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import slices, texts_of
from quern.scratch import spread

SCHEMA = "doc_id long, ids array<int>, decoded string"
MARK, UNKNOWN, BROKEN = "▁", " ⁇ ", "�"


class Numbers(dict):
    """text of a token -> its number: its id, or for a character without a piece a number behind all ids."""

    def __init__(self, pieces: list[str], normal: list[int]):
        super().__init__((pieces[i], i) for i in normal)
        self.text, self.size = list(pieces), list(map(len, pieces))

    def __missing__(self, char: str) -> int:
        value = self[char] = len(self.text)
        self.text.append(char)
        self.size.append(1)
        return value


class Stretches(dict):
    """stretch, without its first mark -> its number in the lists of ids and of decoded texts; filled on demand."""

    def __init__(self, pieces: "Pieces"):
        super().__init__()
        self.pieces, self.ids, self.ends, self.decoded = pieces, array.array("i"), array.array("q", [0]), []

    def __missing__(self, text: str) -> int:
        value = self[text] = len(self.decoded)
        ids = self.pieces.stretch(MARK + text.replace(" ", MARK))
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        self.decoded.append(self.pieces.joined(ids))
        return value


class Pieces:
    """A model's pieces: texts to ids and back. Remembers stretches, their parts and pairs of tokens."""

    def __init__(self, path: str, most: int = 600_000):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.piece = [model.id_to_piece(i) for i in every]
        self.control = {i for i in every if model.IsControl(i)}
        self.unknown = {i for i in every if model.IsUnknown(i)}
        self.byte = {i: int(self.piece[i][3:5], 16) for i in every if model.IsByte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        normal = [i for i in every if i not in self.byte and i not in self.control and i not in self.unknown]
        self.number, self.score = Numbers(self.piece, normal), {self.piece[i]: model.get_score(i) for i in normal}
        odd = "ﬁ a  ① "
        if len(self.byte_id) < 256 or any(model.IsUnused(i) for i in every) or model.Normalize(odd) != MARK + odd.replace(" ", MARK):
            raise ValueError("not a BPE model with byte pieces, without normalisation and with a space mark before the text")
        #: Text of each piece; None for bytes, which are read together.
        self.surface = [None if i in self.byte else "" if i in self.control else UNKNOWN if i in self.unknown else self.piece[i].replace(MARK, " ") for i in every]
        #: Neighbouring characters in any piece: no piece crosses a place between other neighbours.
        self.inside = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.split = not any(x[1] == MARK != x[0] for x in self.inside)
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            if len(self.piece[i]) > 1 and self.merged(self.piece[i]) == [self.piece[i]]:  # others are never reached
                self.automaton.add_word(self.piece[i], i)
        self.automaton.make_automaton()
        self.most, self.known, self.parts, self.pairs = most, Stretches(self), {}, {}

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by its definition: the best pair merges first, the leftmost of equal ones."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when they are neighbours."""
        if len(self.pairs) > 4 * self.most:
            self.pairs.clear()
        tokens = [self.number.text[left], self.number.text[right]]
        out = self.pairs[left << 32 | right] = self.merged("".join(tokens)) == tokens
        return out

    def prefixes(self, text: str) -> list[int]:
        """For every prefix of text, in order of length and from the empty one on, the number of its last token."""
        last, number, size, pairs = [-1] * (len(text) + 1), self.number, self.number.size, self.pairs
        for end, token in self.automaton.iter(text) if len(self.automaton) else ():
            end += 1
            if last[end] >= 0:
                continue
            start = end - size[token]
            if start:
                before = last[start]
                if before < 0:  # no longer token ends there
                    before = last[start] = number[text[start - 1]]
                apart = pairs.get(before << 32 | token)
                if not (self.compatible(before, token) if apart is None else apart):
                    continue
            last[end] = token
        return [t if t >= 0 or not i else number[text[i - 1]] for i, t in enumerate(last)]

    def part(self, text: str) -> list[int]:
        """Ids of a part of a text, from its table of prefixes."""
        last, at, out, size, ids = self.prefixes(text), len(text), [], self.number.size, len(self.piece)
        while at:
            token = last[at]
            out += [token] if token < ids else [self.byte_id[b] for b in reversed(text[at - 1].encode())]
            at -= size[token]
        return out[::-1]

    def stretch(self, text: str) -> list[int]:
        """Ids of a text in which white space is marked: of its parts, between places that no piece crosses."""
        out, a, inside = [], 0, self.inside
        # Words of letters only are seldom cut and often whole parts of other stretches.
        cuts = [] if text[1:].isalpha() else [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in inside]
        for b in [*cuts, len(text)]:
            part = text[a:b]
            ids = self.parts.get(part)
            if ids is None:
                ids = self.part(part)
                if len(part) <= 32:
                    self.parts[part] = ids
            out += ids
            a = b
        return out

    def stretches(self, text: str) -> list[str]:
        """Stretches of a text that no piece crosses, each without the space mark that it begins with."""
        if not text:
            return []
        text = text.replace(MARK, " ") if MARK in text else text
        if not self.split:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [x[1:] for x in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The ids of all texts one after another, where each text's ids end, and what they decode to."""
        if len(self.known) > self.most or len(self.known.ids) > 16 * self.most:
            self.known, self.parts = Stretches(self), {}
        lists = [self.stretches(t) for t in texts]
        which = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
        ends, flat, decoded = np.array(self.known.ends, np.int64), np.array(self.known.ids, np.int32), self.known.decoded
        size = np.diff(ends)[which] if len(which) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(ends[which] - upto[:-1], size) + np.arange(upto[-1])]
        stop, out, a = np.cumsum(list(map(len, lists))), [], 0
        for b in stop.tolist():
            text = "".join(map(decoded.__getitem__, which[a:b].tolist()))
            out.append(text[1:] if text.startswith(" ") else text)
            a = b
        return ids, upto[stop] if len(texts) else np.zeros(0, np.int64), out

    def joined(self, ids: list[int]) -> str:
        """The pieces of ids one after another, runs of byte pieces read as UTF-8, marks as spaces."""
        texts = [self.surface[i] for i in ids]
        if None not in texts:
            return "".join(texts)
        out, run = [], bytearray()
        for i, text in [*zip(ids, texts), (None, "")]:
            if text is None:
                run.append(self.byte[i])
                continue
            while run:
                for n in range(1, 5):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append(BROKEN)
                    n = 1
                del run[:n]
            out.append(text)
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: the mark put before a text is taken off."""
        text = self.joined(ids)
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and first not in self.unknown and self.piece[first].startswith(MARK) else text


@functools.lru_cache(maxsize=1)
def loaded(path: str) -> Pieces:
    """A worker's pieces; the tasks that it runs one after another share what they remember."""
    return Pieces(path)


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of every text; decoded is the text that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in batches:
            for some in slices(batch, "text"):
                flat, ends, texts = pieces.encode(some.column("text").to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return spread(texts_of(docs)).mapInArrow(run, SCHEMA)
