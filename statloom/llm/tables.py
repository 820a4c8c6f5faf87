"""Hash table from 64-bit integers to 32-bit integers, looked up by whole arrays."""

from __future__ import annotations

import numpy as np


class IntTable:
    """Open addressing; keys are distinct and not negative."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.missing = np.int32(missing)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, self.missing, dtype=np.int32)
        keys, values = keys.astype(np.int64), values.astype(np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[free]  # of keys that want one slot the last stays
            placed = self.slots[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.values[at], self.missing)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            found = self.slots[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out
