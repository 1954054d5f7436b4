"""Ids of texts from the ids of their pieces, which a worker remembers.

The tokenizers used here cut a text into words before they merge anything, and a single
space between two other characters always starts a word. So a text may be split at such
spaces, and each piece has its ids for itself. Pieces repeat; a worker keeps their ids in
a memo of bounded size, which is emptied when full: a memo of a pure function.

Pieces of up to 16 bytes, nearly all, are never made into strings: their length and their
first and last eight bytes say all about them and are their key in a table of open
addresses, so the pieces of a few MB of text are looked up at once with numpy.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

#: Slots of the table, as a power of two, and pieces that it may hold; beyond them it starts anew.
SLOT_BITS = 21
MEMO = 5 << (SLOT_BITS - 3)
#: Bytes of a piece that fits the table; longer ones are kept in dictionaries.
SHORT = 16
#: Longer pieces that a worker may keep, and the length from which on they are forgotten after the call.
LONG_MEMO = 200_000
LONG_PIECE = 200

# A space beside other white space, or at the end of the text, does not start a word of its own.
_UNSAFE = re.compile(r" (?:(?=\s|\Z)|(?<=\s ))")
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class PieceTable:
    """Ids of short pieces by their bytes; a piece that starts a text is another than one behind a space."""

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        slots = 1 << SLOT_BITS
        self.low, self.high, self.meta = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.zeros(slots, np.uint8)
        self.at, self.size = np.zeros(slots, np.int32), np.zeros(slots, np.uint8)
        self.ids, self.used, self.held = np.zeros(1 << 16, self.kind), 0, 0

    def keys(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, leads: np.ndarray) -> tuple:
        """Key of each piece of a buffer that is padded by eight bytes on both sides."""
        eight = _windows(raw)
        low = eight[starts] & _MASKS[np.minimum(sizes, 8)]
        high = np.where(sizes > 8, eight[starts + sizes - 8], np.uint64(0))
        return low, high, (sizes + 1 + 32 * leads).astype(np.uint8)

    def find(self, low: np.ndarray, high: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Slot of each key; of one that is not there the empty slot where it belongs, less the number of slots."""
        mixed = (low * _ODD[0]) ^ ((high + _ODD[3]) * _ODD[1]) ^ (meta.astype(np.uint64) * _ODD[2])
        mixed ^= mixed >> np.uint64(31)
        slot = ((mixed * _ODD[0]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = np.empty(len(low), np.int64)
        open_ = np.arange(len(low))
        while len(open_):
            here = slot[open_]
            seen = self.meta[here]
            hit = (seen == meta[open_]) & (self.low[here] == low[open_]) & (self.high[here] == high[open_])
            gap = seen == 0
            out[open_[hit]] = here[hit]
            out[open_[gap]] = here[gap] - len(self.meta)
            open_ = open_[~(hit | gap)]
            slot[open_] = (slot[open_] + 1) & (len(self.meta) - 1)
        return out

    def add(self, low: np.ndarray, high: np.ndarray, meta: np.ndarray, ids: list[bytes]) -> None:
        """Put in keys that are not there, each once."""
        found = np.frombuffer(b"".join(ids), self.kind)
        sizes = np.array([len(x) for x in ids], np.int64) // found.itemsize
        if self.used + len(found) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids), len(found)), self.kind)])
        self.ids[self.used : self.used + len(found)] = found
        at = self.used + np.cumsum(sizes) - sizes
        self.used += len(found)
        self.held += len(ids)
        todo = np.arange(len(ids))
        while len(todo):
            slot = self.find(low[todo], high[todo], meta[todo]) + len(self.meta)
            # Of keys that want one slot the first gets it; the others look on.
            _, first = np.unique(slot, return_index=True)
            put, where = todo[first], slot[first]
            self.low[where], self.high[where], self.meta[where] = low[put], high[put], meta[put]
            self.at[where], self.size[where] = at[put], sizes[put]
            todo = np.delete(todo, first)


def _windows(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number."""
    out = np.empty(len(raw) - 7, "<u8")
    for shift in range(8):
        part = raw[shift : shift + (len(raw) - shift) // 8 * 8].view("<u8")
        out[shift::8] = part[: len(out[shift::8])]
    return out


class PieceCoder:
    """Base of the encoders; ids are little-endian integers of type ``kind``."""

    kind = "<i4"

    def __init__(self):
        #: Ids of long pieces at the start of a text, and of those after a space, which their keys leave out.
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.table: PieceTable | None = None

    def learn(self, first: set[str], rest: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of new pieces: of those that start a text, and of those behind a space."""
        raise NotImplementedError

    def words(self, text: str) -> list[str]:
        """Words of a text that cannot be split at its spaces."""
        raise NotImplementedError

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null counts as empty."""
        plain = [text or "" for text in texts]
        unsafe = [_UNSAFE.search(text) is not None for text in plain]
        out: list[np.ndarray] = [np.zeros(0, self.kind)] * len(plain)
        if safe := [i for i, x in enumerate(unsafe) if not x]:
            for i, ids in zip(safe, self._split([plain[i] for i in safe])):
                out[i] = ids
        for i, x in enumerate(unsafe):
            if x:
                out[i] = self._spelled(self.words(plain[i]))
        for memo in (self.first, self.rest):
            if len(memo) > LONG_MEMO:
                memo.clear()
        return out

    def _spelled(self, words: list[str]) -> np.ndarray:
        """Ids of words that each stand as at the start of a text."""
        new = {w for w in words if w not in self.first}
        found, _ = self.learn(new, set())
        out = np.frombuffer(b"".join([found[w] if w in found else self.first[w] for w in words]), self.kind)
        self.first.update((w, ids) for w, ids in found.items() if len(w) <= LONG_PIECE)
        return out

    def _split(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that may be split at their spaces."""
        if self.table is None:
            self.table = PieceTable(self.kind)
        table = self.table
        joined = " ".join(texts).encode()
        raw = np.frombuffer(b"\0" * 8 + joined + b"\0" * 16, np.uint8)
        spaces = np.flatnonzero(raw[8 : 8 + len(joined)] == 32)
        starts = np.concatenate([[0], spaces + 1])
        sizes = np.concatenate([spaces, [len(joined)]]) - starts
        counts = np.array([text.count(" ") + 1 for text in texts])
        leads = np.zeros(len(starts), np.int64)
        heads = np.cumsum(counts) - counts
        leads[heads] = 1
        brief = np.flatnonzero(sizes <= SHORT)
        low, high, meta = table.keys(raw, starts[brief] + 8, sizes[brief], leads[brief])
        slot = table.find(low, high, meta)
        new = np.flatnonzero(slot < 0)
        if len(new):
            # One place for each new piece.
            order = new[np.lexsort((meta[new], high[new], low[new]))]
            changed = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0) | (np.diff(meta[order].astype(np.int16)) != 0)
            once = order[np.concatenate([[True], changed])]
            if table.held + len(once) > MEMO:
                table.clear()
                order = np.arange(len(slot))[np.lexsort((meta, high, low))]
                changed = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0) | (np.diff(meta[order].astype(np.int16)) != 0)
                once = order[np.concatenate([[True], changed])]
                new = np.arange(len(slot))
            names = [joined[a : a + n].decode() for a, n in zip(starts[brief[once]].tolist(), sizes[brief[once]].tolist())]
            lead = leads[brief[once]].tolist()
            first, rest = self.learn({w for w, x in zip(names, lead) if x}, {w for w, x in zip(names, lead) if not x})
            table.add(low[once], high[once], meta[once], [(first if x else rest)[w] for w, x in zip(names, lead)])
            slot[new] = table.find(low[new], high[new], meta[new])
        lengths = np.zeros(len(starts), np.int64)
        lengths[brief] = table.size[slot]
        long: dict[int, bytes] = {}
        wide = np.flatnonzero(sizes > SHORT)
        if len(wide):
            width = np.dtype(self.kind).itemsize
            names = {i: joined[starts[i] : starts[i] + sizes[i]].decode() for i in wide.tolist()}
            memos = (self.rest, self.first)
            missing = [{w for i, w in names.items() if leads[i] == x and w not in memos[x]} for x in (0, 1)]
            first, rest = self.learn(missing[1], missing[0]) if any(missing) else ({}, {})
            for i, w in names.items():
                found = (rest, first)[leads[i]]
                long[i] = found[w] if w in found else memos[leads[i]][w]
                lengths[i] = len(long[i]) // width
            for memo, found in ((self.first, first), (self.rest, rest)):
                memo.update((w, ids) for w, ids in found.items() if len(w) <= LONG_PIECE)
        ends = np.cumsum(lengths)
        begin = ends - lengths
        place = np.zeros(len(starts), np.int64)
        place[brief] = table.at[slot]
        # Ids of long pieces are not in the table; their places are filled below.
        place[wide] = 0
        spread = np.arange(int(ends[-1])) - np.repeat(begin, lengths)
        spread[np.repeat(sizes > SHORT, lengths)] = 0
        whole = table.ids[np.repeat(place, lengths) + spread]
        for i, ids in long.items():
            whole[begin[i] : ends[i]] = np.frombuffer(ids, self.kind)
        return np.split(whole, begin[heads[1:]])


def all_words(found: dict[str, list[str]]) -> set[str]:
    return set(chain.from_iterable(found.values()))
