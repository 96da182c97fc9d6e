"""Rank-synchronous byte-pair merging over ragged arrays of pre-tokens.

A batch's pre-tokens lie one after another in one symbol array. Each round finds every pre-token's lowest merge rank
and merges all places with that rank in all pre-tokens at once (overlapping places of a doubled symbol from the left).
Ranks are looked up again only next to merged places. A pre-token without a mergeable pair is finished.
"""

import json

import numpy as np

NONE = np.int32(2**31 - 1)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """The vocabulary of a byte-level BPE .json file as arrays: the symbol of each byte, and pair -> (rank, merged)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, pairs = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        suffix, chars = model.get("end_of_word_suffix") or "", [c for _, c in sorted(byte_symbols().items())]
        self.byte = np.array([vocab[c] for c in chars], np.int32)
        self.last_byte = np.array([vocab[c + suffix] for c in chars], np.int32)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.bits, self.tables, left = 18, [], np.arange(len(keys))
        for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0x94D049BB133111EB):
            slot = self.slot(keys[left], factor)
            held, rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
            held[slot], rank[slot] = keys[left], left
            self.tables.append((factor, held, rank))
            left = left[rank[slot] != left]
            if not len(left):
                break
        assert not len(left), "the pairs don't fit the tables"

    def slot(self, key: np.ndarray, factor: int) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        out = np.full(len(key), NONE, np.int32)
        rest = np.arange(len(key))
        for factor, held, rank in self.tables:
            slot = self.slot(key[rest], factor)
            there = held[slot]
            ok = there == key[rest]
            out[rest[ok]] = rank[slot[ok]]
            rest = rest[~ok & (there >= 0)]  # an empty slot: no later table holds the pair either
            if not len(rest):
                break
        return out

    def merge(self, tokens: list[bytes], symbols: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Symbols left of all (non-empty) pre-tokens, one after another (None if not asked for), and their counts."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        counts, who, done = size.copy(), np.arange(len(tokens)), []
        data = np.frombuffer(b"".join(tokens), np.uint8)
        sym, last = self.byte[data], np.zeros(len(data), bool)
        last[np.cumsum(size) - 1] = True
        sym[last] = self.last_byte[data[last]]
        rank = np.full(len(sym), NONE)
        inner = np.flatnonzero(~last)
        rank[inner] = self.ranks(sym[inner], sym[inner + 1])
        while len(who):
            start = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, start)
            going = low < NONE
            if not going.all():
                stays = np.repeat(going, size)
                counts[who[~going]] = size[~going]
                if symbols:
                    done.append((np.repeat(who[~going], size[~going]), sym[~stays]))
                sym, rank, last, size, who, low = sym[stays], rank[stays], last[stays], size[going], who[going], low[going]
                start = np.cumsum(size) - size
                if not len(who):
                    break
            at = np.flatnonzero(rank == np.repeat(low, size))
            if (sym[at] == sym[at + 1]).any():
                run = np.cumsum(np.diff(at, prepend=-2) != 1)
                at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            sym[at] = self.merged[rank[at]]
            last[at] = last[at + 1]
            size = size - np.add.reduceat(gone, start, dtype=np.int64)
            keep = ~gone
            sym, last, rank = sym[keep], last[keep], rank[keep]
            at = at - np.arange(len(at))  # each merge before it removed one symbol
            rank[at] = NONE
            before = at[at > 0] - 1
            before = before[~last[before]]
            beside = np.zeros(len(sym), bool)
            beside[at[~last[at]]] = True
            beside[before] = True
            near = np.flatnonzero(beside)
            rank[near] = self.ranks(sym[near], sym[near + 1])
        if not symbols:
            return None, counts
        owner, found = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        return found[np.argsort(owner, kind="stable")], counts
