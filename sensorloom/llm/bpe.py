"""Byte-pair merges over ragged numpy batches, shared by token counts and byte-level encoding.

Many pre-tokens are merged together: all their symbols lie in one flat array, and in every round each
sequence applies its own lowest-ranked pair.  All places of that pair are merged at once, from the
left, unless a symbol made by it could start a pair of lower rank; then only the leftmost place is.
"""

from __future__ import annotations

import base64
import itertools
import json

import numpy as np
import regex

_NONE = np.iinfo(np.int64).max

#: The split pattern of the rank files, with white space as Unicode defines it.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


class Merges:
    """Ranks of symbol pairs in an open hash table that is read by whole arrays."""

    def __init__(self, byte_ids: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray, into: np.ndarray):
        self.byte_ids = byte_ids.astype(np.int64)
        keys = self._key(left.astype(np.int64), right.astype(np.int64))
        lowest = np.full(int(max(into.max(), left.max(), right.max(), byte_ids.max())) + 1, _NONE)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        values = (rank, into, lowest[into] < rank)
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 3))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        slots = np.empty(len(keys), np.int64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] < 0
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            placed = first[free[first]]
            self.keys[at[placed]] = keys[todo[placed]]
            slots[todo[placed]] = at[placed]
            rest = np.ones(len(todo), bool)
            rest[placed] = False
            todo, at = todo[rest], (at[rest] + 1) & ((1 << self.bits) - 1)
        self.rank = np.full(1 << self.bits, _NONE)
        self.into = np.zeros(1 << self.bits, np.int64)
        self.unsafe = np.zeros(1 << self.bits, bool)
        for column, value in zip((self.rank, self.into, self.unsafe), values):
            column[slots] = value

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left << 24) | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; an empty slot, which has no rank, where the pair has none."""
        keys = self._key(left, right)
        at = self._slot(keys)
        there = self.keys[at]
        wrong = np.flatnonzero((there != keys) & (there >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[wrong]]
            wrong = wrong[(there != keys[wrong]) & (there >= 0)]
        return at

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and their number for each piece."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        slot = self._pairs(ids, owner, np.arange(len(ids)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            rank = self.rank[slot]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == _NONE
            if over.any():
                gone = np.repeat(over, sizes)
                done.append((owner[gone], ids[gone]))
                ids, owner, slot, rank = ids[~gone], owner[~gone], slot[~gone], rank[~gone]
                lowest, sizes = lowest[~over], sizes[~over]
                if not len(ids):
                    break
            places = np.flatnonzero(rank == np.repeat(lowest, sizes))
            fresh = np.r_[True, places[1:] != places[:-1] + 1]
            run = np.maximum.accumulate(np.where(fresh, places, 0))
            chosen = (places - run) % 2 == 0
            first = np.r_[True, owner[places][1:] != owner[places][:-1]]
            places = places[chosen & (first | ~self.unsafe[slot[places]])]
            ids[places] = self.into[slot[places]]
            stay = np.ones(len(ids), bool)
            stay[places + 1] = False
            merged = (np.cumsum(stay) - 1)[places]
            ids, owner, slot = ids[stay], owner[stay], slot[stay]
            touched = np.unique(np.r_[merged, merged[merged > 0] - 1])
            slot[touched] = self._pairs(ids, owner, touched)
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(pieces), np.int64)
        owners, symbols = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(owners, kind="stable")
        return symbols[order], np.bincount(owners, minlength=len(pieces))

    def _pairs(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Slots of the pairs that start at these places; of no pair at the end of a sequence."""
        after = np.minimum(at + 1, len(ids) - 1)
        inside = (after > at) & (owner[after] == owner[at])
        return self.look(np.where(inside, ids[at], (1 << 38) - 1), ids[after])


class Vocabulary:
    """Merges of one tokenizer file, the bytes of its ids, and what its pre-tokens encode to.

    The store of pre-tokens is bounded: it is emptied when it holds ``limit`` of them.
    """

    def __init__(self, merges: Merges, whole: dict[bytes, int] | None, tokens: dict[int, bytes],
                 specials: dict[str, int], limit: int = 200_000):
        self.merges, self.whole, self.tokens, self.specials, self.limit = merges, whole, tokens, specials, limit
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def slots(self, pieces: list[str]) -> np.ndarray:
        """Place of each pre-token in the store; encodes those that are new."""
        new = [piece for piece in set(pieces) if piece not in self.index]
        if new:
            if len(self.index) + len(new) > self.limit:
                self._forget()
                new = list(set(pieces))
            raw = [piece.encode() for piece in new]
            ids, lengths = self._encode(raw)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(lengths) - lengths]
            self.lengths = np.r_[self.lengths, lengths]
            self.ids = np.r_[self.ids, ids.astype(np.int32)]
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def _encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A piece that is a token of a rank file is that token, whatever its merges give."""
        known = [self.whole.get(piece, -1) for piece in raw] if self.whole else [-1] * len(raw)
        ids, lengths = self.merges.encode([piece for piece, one in zip(raw, known) if one < 0])
        known = np.array(known, np.int64)
        counts = np.ones(len(raw), np.int64)
        counts[known < 0] = lengths
        out = np.empty(int(counts.sum()), np.int64)
        whole = np.repeat(known >= 0, counts)
        out[whole], out[~whole] = known[known >= 0], ids
        return out, counts

    def lengths_of(self, pieces: list[str]) -> np.ndarray:
        slots = self.slots(pieces)
        return self.lengths[slots]

    def gather(self, slots: np.ndarray) -> np.ndarray:
        """Ids of pre-tokens one after the other."""
        counts = self.lengths[slots]
        first = np.cumsum(counts) - counts
        return self.ids[np.repeat(self.starts[slots] - first, counts) + np.arange(int(counts.sum()))]

    def raw(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids one after the other, and how many each has."""
        if not hasattr(self, "_sizes"):
            known = [self.tokens.get(one, b"") for one in range(max(self.tokens) + 1)]
            self._sizes = np.fromiter(map(len, known), np.int64, len(known))
            self._firsts = np.cumsum(self._sizes) - self._sizes
            self._bytes = np.frombuffer(b"".join(known), np.uint8)
        sizes = self._sizes[ids]
        first = np.cumsum(sizes) - sizes
        places = np.repeat(self._firsts[ids] - first, sizes) + np.arange(int(sizes.sum()))
        return self._bytes[places], sizes

    def parts(self, text: str) -> list[str]:
        """Pre-tokens, with strings of special tokens as pieces of their own."""
        if not any(special in text for special in self.specials):
            return SPLIT.findall(text)
        cut = regex.split("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")", text)
        pieces = []
        for place, part in enumerate(cut):
            pieces += [part] if place % 2 else SPLIT.findall(part)
        return pieces


def _bytes_of_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in a .json vocabulary: bytes that print stand for
    themselves, the others for the letters from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printing)]
    return {chr(byte): byte for byte in printing} | {chr(256 + place): byte for place, byte in enumerate(others)}


def _from_ranks(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    pairs = [
        (ranks[token[:cut]], ranks[token[cut:]], rank, rank)
        for token, rank in ranks.items() for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks]
    byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)])
    merges = Merges(byte_ids, *np.array(pairs, np.int64).T)
    return Vocabulary(merges, ranks, {rank: token for token, rank in ranks.items()}, {})


def _from_json(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary, letters = content["model"]["vocab"], _bytes_of_letters()
    pairs = [
        (vocabulary[left], vocabulary[right], rank, vocabulary[left + right])
        for rank, (left, right) in enumerate(content["model"]["merges"])]
    byte_ids = np.empty(256, np.int64)
    for letter, byte in letters.items():
        byte_ids[byte] = vocabulary[letter]
    specials = {token["content"]: token["id"] for token in content["added_tokens"]}
    tokens = {
        id_: bytes(letters[letter] for letter in token)
        for token, id_ in vocabulary.items() if all(letter in letters for letter in token)}
    return Vocabulary(Merges(byte_ids, *np.array(pairs, np.int64).T), None, tokens, specials)


_LOADED: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    """The vocabulary of a .tiktoken or .json file; kept in the worker."""
    if path not in _LOADED:
        _LOADED[path] = _from_ranks(path) if path.endswith(".tiktoken") else _from_json(path)
    return _LOADED[path]


def flattened(lists: list[list[str]]) -> tuple[list[str], np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return list(itertools.chain.from_iterable(lists)), sizes


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of these sizes, which may be empty."""
    running = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(sizes)
    return running[ends] - running[ends - sizes]
