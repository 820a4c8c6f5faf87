"""Cutting text where a byte-level tokenizer certainly starts a new match, and remembering what a cut-off unit encodes to.

A space that is followed by a character which is not white space always starts a match of the public
split pattern, whatever precedes it: letters, digits and signs each take one leading space, and a run of white space leaves its
last one to what follows. So a text can be encoded as its units, each with its leading space,
and equal units encode alike.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

_CUT = re.compile(r" (?=\S)")
_UNSAFE = re.compile(r" (?:\s|\Z)")
SIGNS = string.punctuation


_REMEMBERED: dict[str, dict] = {}


def remembered(vocabulary: str) -> dict:
    """What this worker process remembers of a vocabulary, named by a digest. Only the one it used last is kept, also over many queries."""
    if vocabulary not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[vocabulary] = {}
    return _REMEMBERED[vocabulary]


def units(text: str) -> list[str]:
    """First unit as it stands; each further one without the space that precedes it."""
    return _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")


class UnitCache:
    """Values of the units seen lately; `encode` takes a list of whole unit texts and returns one value for each.

    Values can be added: signs at the end of a unit of letters are a match of their own, so such a unit is the sum of
    its letters and its signs. `kept` holds the values. Taken from a broadcast, it lasts as long as the worker process and
    serves its later tasks too. When it holds `limit` units, those not asked for since the last time are dropped, so memory stays
    bounded on any text.
    """

    def __init__(self, encode: Callable[[list[str]], list], kept: dict | None = None, limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self.kept = {} if kept is None else kept
        for part in ("heads", "tails", "older"):
            self.kept.setdefault(part, {})

    def lookup(self, texts: list[str]) -> list[list]:
        """For each text the values of its units in order."""
        kept = self.kept
        if len(kept["tails"]) + len(kept["heads"]) > self.limit:
            kept["older"], kept["tails"], kept["heads"] = kept["tails"], {}, {}
        heads, tails, older = kept["heads"], kept["tails"], kept["older"]
        cut = [units(t) for t in texts]
        asked = set().union(*cut) - tails.keys()
        known = asked & older.keys()
        tails.update(zip(known, map(older.__getitem__, known)))
        first, rest, whole = {parts[0] for parts in cut} - heads.keys(), set(), []
        for unit in asked - known:
            letters = unit.rstrip(SIGNS)
            if letters != unit and letters.isalpha():
                whole.append((unit, letters))
                if unit[len(letters) :] not in heads:
                    first.add(unit[len(letters) :])
                if letters not in tails:
                    rest.add(letters)
            else:
                rest.add(unit)
        first, rest = list(first), list(rest)
        if first or rest:
            values = self.encode(first + [f" {u}" for u in rest])
            heads.update(zip(first, values))
            tails.update(zip(rest, values[len(first) :]))
        for unit, letters in whole:
            tails[unit] = tails[letters] + heads[unit[len(letters) :]]
        get = tails.__getitem__
        return [[heads[parts[0]], *map(get, parts[1:])] for parts in cut]
