"""Ids of whole columns of text by remembered units, on arrays.

Texts are cut on their bytes: unit starts, hashes and look-ups are array operations, and a unit's ids are copied from a pool. Only units not
met before become strings and go to the library, words of one batch together. Cuts lie where the tokenizer certainly starts a new match: at a
space before anything but white space, around a line break between other characters, and between a letter or digit and signs
that end a unit. Two units share a 64-bit hash with a chance of 2 ** -64 a pair.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash

from .library import Library

UNITS, POOL = 1 << 20, 1 << 24  # remembered units, and their ids; beyond either, all are forgotten
LONG = 256  # bytes of a unit that is hashed as a whole
_FACTOR, _HEAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LEADS = np.zeros(256, dtype=bool)  # first bytes of white space beyond ASCII
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in string.punctuation]] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[[ord(c) for c in string.ascii_letters + string.digits]] = True
_WIDE = np.array([int.from_bytes(chr(c).encode(), "big") for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])


class UnitTable:
    """Open addressing from 64-bit hashes to places in a pool of ids; grows, and takes many keys at a time."""

    def __init__(self, dtype):
        self.bits, self.size, self.used = 12, 0, 0
        self.keys, self.entry = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        self.start, self.count = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.pool = np.zeros(4096, dtype)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 for an unknown one."""
        at = ((keys * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.entry[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.entry[at[open_]]
            out[open_] = found
            open_ = open_[(found >= 0) & (self.keys[at[open_]] != keys[open_])]
        return out

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        at = ((keys * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.entry[at] < 0)
            self.entry[at[free]] = entries[free]  # of keys that want one slot the last stays
            placed = self.entry[at] == entries
            self.keys[at[placed]] = keys[placed]
            keys, entries, at = keys[~placed], entries[~placed], (at[~placed] + 1) & (len(self.keys) - 1)

    def add(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Remember distinct new keys with their ids, one after another; returns their entries."""
        first, n = self.size, len(keys)
        while self.size + n > len(self.start):
            self.start, self.count = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.count))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        entries = np.arange(first, first + n, dtype=np.int32)
        self.count[entries] = counts
        self.start[entries] = self.used + np.cumsum(counts) - counts
        self.pool[self.used : self.used + len(ids)] = ids
        self.size, self.used = first + n, self.used + len(ids)
        if 2 * self.size > len(self.keys):
            filled = np.flatnonzero(self.entry >= 0)
            keys, old = np.concatenate([self.keys[filled], keys]), np.concatenate([self.entry[filled], entries])
            while 2 * self.size > 1 << self.bits:
                self.bits += 1
            self.keys, self.entry = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
            self._place(keys, old)
        else:
            self._place(keys, entries)
        return entries


def unit_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every unit of the texts `data[offsets[i]:offsets[i + 1]]`, in order, whether a space precedes it that belongs to it,
    and the place of each text's first unit."""
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets[:-1]] = True
    space = np.flatnonzero(data[:-1] == 32) if n else np.zeros(0, np.int64)
    tails = space[_solid(data, space + 1) & ~first[space + 1]] + 1
    breaks = np.flatnonzero(data[1:-1] == 10) + 1 if n > 2 else np.zeros(0, np.int64)
    breaks = breaks[~_BLANK[data[breaks - 1]] & ~first[breaks] & ~first[breaks + 1]]
    breaks = breaks[_solid(data, breaks + 1) & _plain_end(data, breaks)]
    start = np.concatenate([offsets[:-1], tails, breaks, breaks + 1])
    kind = np.repeat(np.array([0, 1, 2, 2], np.int8), [len(offsets) - 1, len(tails), len(breaks), len(breaks)])
    order = np.argsort(start, kind="stable")
    start, kind = start[order], kind[order]
    end = np.append(start[1:] - (kind[1:] == 1), n)

    # signs at the end of a unit
    cut, live = end.copy(), np.flatnonzero(end > start)
    while len(live):
        live = live[(cut[live] > start[live]) & _SIGN[data[cut[live] - 1]]]
        cut[live] -= 1
    split = np.flatnonzero((cut < end) & (cut > start))
    split = split[_ends_word(data, start[split], cut[split])]
    start, end = np.insert(start, split + 1, cut[split]), np.insert(end, split, cut[split])
    kind = np.insert(kind, split + 1, np.int8(2))
    return start, end, kind == 1, np.flatnonzero(kind == 0)


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character at each place is certainly no white space."""
    out = ~_BLANK[data[at]]
    wide = np.flatnonzero(out & _LEADS[data[at]])
    if len(wide):
        n, at = len(data), at[wide]
        one, two, three = data[at].astype(np.int64), data[np.minimum(at + 1, n - 1)].astype(np.int64), data[np.minimum(at + 2, n - 1)].astype(np.int64)
        blank = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        out[wide] = ~(blank | np.isin(one << 16 | two << 8 | three, _WIDE))
    return out


def _plain_end(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is ASCII or a Latin letter of two bytes, so certainly no white space beyond ASCII."""
    before, lead = data[at - 1], data[np.maximum(at - 2, 0)]
    return (before < 128) | (lead >= 0xC3) & (lead <= 0xC5)


def _ends_word(data: np.ndarray, start: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is a letter or digit of ASCII or a Latin letter of two bytes."""
    before, lead = data[at - 1], data[np.maximum(at - 2, 0)]
    latin = (at - 2 >= start) & (before >= 128) & (((lead == 0xC3) & (before != 0x97) & (before != 0xB7)) | (lead == 0xC4) | (lead == 0xC5))
    return _WORD[before] | latin


def unit_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> np.ndarray:
    """64-bit hashes of units, those with a space before them apart from those without."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))  # eight bytes from any place
    out = size.astype(np.uint64) * _FACTOR
    out[~spaced] ^= _HEAD
    live, done = np.flatnonzero(size <= LONG), 0
    while len(live):
        rest = size[live] - done
        out[live] = (out[live] ^ (words[start[live] + done] & _MASKS[np.clip(rest, 0, 8)])) * _FACTOR
        out[live] ^= out[live] >> np.uint64(31)
        done += 8
        live = live[rest > 8]
    for i in np.flatnonzero(size > LONG):
        out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes()))
    return out


class UnitIds:
    """Encoder of whole columns with the library of a vocabulary file."""

    def __init__(self, shared: dict, dtype):
        self.library, self.dtype = Library(shared), dtype

    def _table(self) -> UnitTable:
        table = self.library.kept.get("table")
        if table is None or table.pool.dtype != self.dtype or table.size > UNITS or table.used > POOL:
            table = self.library.kept["table"] = UnitTable(self.dtype)
        return table

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of each text; a NULL text is an empty one."""
        texts = texts.cast(pa.string()).fill_null("")
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if not self.library.cuts:
            return self._joined([self.library.whole(t) for t in texts.to_pylist()])
        special = np.zeros(len(texts), dtype=bool)
        for s in self.library.special:
            special |= pa.compute.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if special.any():  # a special string is one id, so such texts are for the library as they are
            parts = [self.library.whole(t.as_py()) if s else None for t, s in zip(texts, special)]
            flat, counts = self._units(texts.filter(pa.array(~special)))
            others = iter(np.split(flat, np.cumsum(counts)[:-1])) if len(counts) else iter(())
            return self._joined([next(others) if p is None else p for p in parts])
        return self._units(texts)

    def _joined(self, parts: list) -> tuple[np.ndarray, np.ndarray]:
        arrays = [np.frombuffer(p, "<u4").astype(self.dtype) if isinstance(p, bytes) else p for p in parts]
        return np.concatenate(arrays), np.array([len(a) for a in arrays], dtype=np.int64)

    def _units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        bytes_ = texts.buffers()[2]
        data = np.frombuffer(bytes_, np.uint8)[offsets[0] : offsets[-1]] if bytes_ is not None else np.zeros(0, np.uint8)
        start, end, spaced, heads = unit_bounds(data, offsets - offsets[0])
        keys, table = unit_hashes(data, start, end, spaced), self._table()
        entry = table.find(keys)
        new = np.flatnonzero(entry < 0)
        if len(new):
            distinct, at, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            at, raw = new[at], data.tobytes()
            found = self.library.unit_ids([raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())], spaced[at].tolist())
            entry[new] = table.add(distinct, *found)[inverse]
        counts = table.count[entry].astype(np.int64)
        ends = np.cumsum(counts)
        places = np.repeat(table.start[entry] - (ends - counts), counts) + np.arange(ends[-1])
        return table.pool[places], np.add.reduceat(counts, heads)
