"""The public tokenizer libraries inside Arrow tasks, with remembered units where units encode independently."""

from __future__ import annotations

import hashlib
import json
import os
import sys
from array import array
from pathlib import Path

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .units import UnitCache, remembered

WORDS = 10_000  # words given to the model at once


def vocabulary_file(path: str) -> dict:
    """The vocabulary file and what `Library` must know of it, a few MB whatever the data."""
    data = Path(path).read_bytes()
    found = {"file": data, "digest": hashlib.sha256(data).hexdigest(), "piece": path.endswith(".model"), "cuts": False, "special": []}
    if not found["piece"]:
        stated = json.loads(data)
        split, added = stated.get("pre_tokenizer") or {}, stated.get("added_tokens", [])
        found["special"] = [t["content"] for t in added]
        plain = stated.get("normalizer") is None and stated.get("post_processor") is None
        plain = plain and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        vocabulary = stated["model"]["vocab"]
        opens = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        opens[[i for t, i in vocabulary.items() if t.startswith(byte_letters()[32])]] = True
        found["opens"] = opens
        found["cuts"] = plain and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in added)
    return found


def shared_vocabulary(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(vocabulary_file(path))


def _bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Library:
    """Token ids and counts as the library of a vocabulary file gives them.

    For a byte-level .json that splits by the public pattern and changes nothing else, texts are cut into units, and each new unit
    goes to the library once: a word of common letters straight to its model, as such a word is one match, and anything else through
    all its steps. A text that contains a special string goes there whole. Other files get whole texts.
    """

    def __init__(self, shared: dict):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.piece, self.cuts, self.special = shared["piece"], shared["cuts"], shared["special"]
        self.kept = remembered(shared["digest"])
        if "model" not in self.kept:
            if self.piece:
                self.kept["model"] = sentencepiece.SentencePieceProcessor(model_proto=shared["file"])
            else:
                self.kept["model"] = Tokenizer.from_buffer(shared["file"])
                self.kept["model"].no_truncation()
                self.kept["model"].no_padding()
        self.model = self.kept["model"]
        self.word = self.model.model.tokenize if self.cuts else None
        self.letters = byte_letters()
        self.opens = shared.get("opens")
        self.words = Tokenizer(self.model.model) if self.cuts else None  # the same model without the steps before it

    def _tokens(self, unit: str):
        """The model's tokens of a unit that is one match of common letters; None if it isn't."""
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha() and max(word) < "\u0530":
            return self.word(unit.encode().decode("latin-1").translate(self.letters))
        return None

    def _units(self, units: list[str], of_tokens, of_texts) -> list:
        found = [self._tokens(u) for u in units]
        others = iter(of_texts([u for u, t in zip(units, found) if t is None]))
        return [next(others) if t is None else of_tokens(t) for t in found]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        if self.piece:
            return self.model.encode(texts, num_threads=1)
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _lengths(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for start in range(0, len(texts), 20_000):
            part = texts[start : start + 20_000]
            if self.piece:
                out += map(len, self._whole(part))
            else:
                out += map(len, self.model.encode_batch_fast(part, add_special_tokens=False))
        return out

    def _by_units(self, texts: list[str], encode, of_tokens, kind: str, join) -> list:
        special = [any(s in t for s in self.special) for t in texts] if self.cuts else [True] * len(texts)
        cut = UnitCache(lambda u: self._units(u, of_tokens, encode), self.kept.setdefault(kind, {})).lookup([t for t, s in zip(texts, special) if not s])
        whole = encode([t for t, s in zip(texts, special) if s])
        cut, whole = iter(cut), iter(whole)
        return [next(whole) if s else join(next(cut)) for s in special]

    def whole(self, text: str) -> bytes:
        """Ids of a text through all the library's steps, as little-endian unsigned 32-bit integers."""
        return _bytes(self._whole([text])[0])

    def unit_ids(self, units: list[bytes], spaced: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and the number of each. Words of common letters are one match each and go to
        the library's model together, written in its letters; anything else goes through all its steps."""
        words, places, parts, owners = [], [], [], []

        def put(i: int, ids: np.ndarray) -> None:
            parts.append(ids)
            owners.append(np.full(len(ids), i))

        for i, (unit, after) in enumerate(zip(units, spaced)):
            if unit.isalpha():  # bytes: ASCII letters
                word = unit.decode()
            else:
                text = unit.decode()
                if not text.isalpha() or max(text) >= "\u0530":
                    put(i, np.frombuffer(self.whole(f" {text}" if after else text), "<u4"))
                    continue
                word = unit.decode("latin-1").translate(self.letters)
            if after:
                words.append(self.letters[32] + word)
                places.append(i)
            else:
                put(i, np.array([t.id for t in self.word(word)], np.uint32))
        for at in range(0, len(words), WORDS):
            found = self.words.encode_batch_fast([words[at : at + WORDS]], is_pretokenized=True, add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype=np.uint32)
            parts.append(ids)  # a word's first token, and no other, begins with the space
            owners.append(np.array(places[at : at + WORDS])[np.cumsum(self.opens[ids]) - 1])
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(len(units), np.int64)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(parts)[order], np.bincount(owner, minlength=len(units))

    def lengths(self, texts: list[str]) -> list[int]:
        """Number of ids of each text; the ids are never put together."""
        return self._by_units(texts, self._lengths, len, "lengths", sum)
