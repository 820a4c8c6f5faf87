"""Byte-level BPE encoding with a segment tree of pair ranks, and decoding.

Leaves of the tree are the byte positions of one piece of text; a leaf holds the rank of the pair that starts there, a node the
leftmost minimum below it. The root names the next merge, and a merge changes three leaves and their ancestors.
Short pieces are merged side by side in numpy, one merge of every piece per step; long pieces
one at a time, in n log n steps.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import lean, pieces_of, texts_of
from .tables import IntTable
from .units import UnitCache, remembered

NONE = np.int32(2**31 - 1)
WIDEST = 128  # leaves of a tree that is merged side by side with others
ROWS = 8192  # pieces merged side by side
ENCODED_BYTES = 1 << 20  # text encoded at a time; its units and ids take some 20 times as much
UNITS = 100_000  # units that a worker remembers, twice as many while they change over
_SIGNS = tuple(".,;:!?")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_tables(path: str, pattern: str) -> dict:
    """What encoding needs, in plain types: ranks, the pairs that merge, also as arrays. `digest` names the vocabulary."""
    ranks = read_ranks(path)
    if len(ranks) > 1 << 16 or max(ranks.values()) >= 1 << 16:
        raise ValueError("at most 65,536 ranks")
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 16 | right] = rank
    table = np.fromiter(pairs.keys(), dtype=np.int64, count=len(pairs)), np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
    return {"ranks": ranks, "pattern": pattern, "pairs": pairs, "table": table, "digest": hashlib.sha256(Path(path).read_bytes() + pattern.encode()).hexdigest()}


class ByteBPE:
    """Encoder and decoder over `merge_tables`: a token's id is its rank."""

    def __init__(self, tables: dict):
        self.ranks, self.pattern, self.pairs = tables["ranks"], tables["pattern"], tables["pairs"]
        self.kept = remembered(tables["digest"])
        self.matches = regex.compile(self.pattern).findall
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.table = IntTable(*tables["table"], missing=NONE)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it doesn't merge or either side is missing (negative)."""
        ranks = self.table.get(np.maximum(left << 16 | right, 0))
        ranks[(left < 0) | (right < 0)] = NONE
        return ranks

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        by_leaves: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > WIDEST:
                out[i] = np.array(self.encode_long(piece), dtype="<u4").tobytes()
            else:
                by_leaves.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for leaves, which in by_leaves.items():
            for start in range(0, len(which), ROWS):
                part = which[start : start + ROWS]
                for i, ids in zip(part, self._merge_side_by_side([pieces[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _merge_side_by_side(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), dtype=np.uint8).reshape(n, leaves)
        sizes = np.array([len(p) for p in pieces])
        position = np.arange(leaves)
        ids = np.full((n, leaves + 1), -1, dtype=np.int64)  # the last column stands for "no neighbour"
        ids[:, :leaves] = np.where(position < sizes[:, None], self.bytes[raw], -1)
        after = np.full((n, leaves + 1), leaves, dtype=np.int64)
        after[:, :leaves] = np.where(position + 1 < sizes[:, None], position + 1, leaves)
        before = np.full((n, leaves + 1), leaves, dtype=np.int64)
        before[:, 1:leaves] = position[: leaves - 1]
        tree = np.full((n, 2 * leaves), NONE, dtype=np.int32)
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, leaves)
        tree[:, leaves:] = np.where(ranks == NONE, NONE, ranks * np.int32(leaves) + position.astype(np.int32))
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        wide = leaves + 1
        ids_, after_, before_, tree_ = ids.ravel(), after.ravel(), before.ravel(), tree.ravel()
        live = np.flatnonzero(tree[:, 1] != NONE)
        row, top = live * wide, live * 2 * leaves  # where a piece starts in the flat arrays
        best = tree_[top + 1]
        while len(row):
            at, rank = best % leaves, best // leaves
            gone = after_[row + at]
            next_ = after_[row + gone]
            prior = before_[row + at]
            ids_[row + at] = rank
            ids_[row + gone] = -1
            after_[row + at] = next_
            before_[row + next_] = at
            before_[row + leaves] = leaves
            some = prior < leaves
            self._put(tree_, top, leaves, gone, NONE)
            self._put(tree_, top, leaves, at, self._leaf(ids_, row, at, next_, leaves))
            self._put(tree_, top[some], leaves, prior[some], self._leaf(ids_, row[some], prior[some], at[some], leaves))
            best = tree_[top + 1]
            more = best != NONE
            row, top, best = row[more], top[more], best[more]
        flat = ids[:, :leaves]
        kept = flat >= 0
        ends = (np.cumsum(kept.sum(1)) * 4).tolist()
        values = flat[kept].astype("<u4").tobytes()
        return [values[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    @staticmethod
    def _put(tree: np.ndarray, top: np.ndarray, leaves: int, leaf: np.ndarray, key) -> None:
        """New key of one leaf in each tree, and of the nodes above it."""
        node = leaf + leaves
        tree[top + node] = key
        while leaves > 1:
            pair = top + (node & -2)
            node = node >> 1
            tree[top + node] = np.minimum(tree[pair], tree[pair + 1])
            leaves >>= 1

    def _leaf(self, ids: np.ndarray, row: np.ndarray, left: np.ndarray, right: np.ndarray, leaves: int) -> np.ndarray:
        ranks = self.pair_ranks(ids[row + left], ids[row + right])
        return np.where(ranks == NONE, NONE, ranks * np.int32(leaves) + left.astype(np.int32))

    def encode_long(self, piece: bytes) -> list[int]:
        """One piece of any length, by the same tree."""
        n = len(piece)
        leaves = 1 << max(1, (n - 1).bit_length())
        none = 1 << 62
        get = self.pairs.get
        ids = self.bytes[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = get(ids[i] << 16 | ids[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, key: int) -> None:
            node = leaf + leaves
            tree[node] = key
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                best = a if a < b else b
                if tree[node] == best:
                    return
                tree[node] = best

        def key(left: int, right: int) -> int:
            rank = get(ids[left] << 16 | ids[right]) if right < n else None
            return none if rank is None else rank * leaves + left

        while tree[1] != none:
            rank, at = divmod(tree[1], leaves)
            gone = after[at]
            next_ = after[gone]
            ids[at], ids[gone] = rank, -1
            after[at] = next_
            if next_ < n:
                before[next_] = at
            put(gone, none)
            put(at, key(at, next_))
            if before[at] >= 0:
                put(before[at], key(before[at], at))
        return [i for i in ids if i >= 0]

    def matches_of(self, unit: str) -> list[str]:
        """Matches of the pattern; most units are letters, or letters and one sign, and need no search."""
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha():
            return [unit]
        if word[-1:] in _SIGNS and word[:-1].isalpha():
            return [unit[:-1], unit[-1:]]
        return self.matches(unit)

    def encode_units(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, every match of the pattern encoded by itself."""
        cut = [self.matches_of(t) for t in texts]
        distinct = list(set().union(*cut))
        ids = dict(zip(distinct, self.encode_pieces([m.encode() for m in distinct])))
        return [ids[m[0]] if len(m) == 1 else b"".join(map(ids.__getitem__, m)) for m in cut]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        units = UnitCache(self.encode_units, self.kept, UNITS).lookup(texts)
        return [np.frombuffer(b"".join(found), dtype="<u4") for found in units]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _encoded(batches: Iterator[pa.RecordBatch], model: ByteBPE) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for part in pieces_of(batch, limit=ENCODED_BYTES):
            yield part.column("doc_id"), model.encode([t or "" for t in part.column("text").to_pylist()])


def shared_tables(df: DataFrame, path: str, pattern: str):
    """The rank file, read once by the driver; at most 65,536 tokens, so the broadcast is bounded by the vocabulary."""
    return df.sparkSession.sparkContext.broadcast(merge_tables(path, pattern))


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, ids`: token ids of every whole text.

    A NULL or empty text has no ids. Rows are handled one by one: a NULL or repeated id gives its row all the same, and other
    columns are not looked at. An empty table gives an empty one.
    """
    tables = shared_tables(df, path, pattern)

    def run(batches):
        for doc_id, ids in _encoded(batches, ByteBPE(tables.value)):
            ends = np.cumsum([0, *map(len, ids)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([doc_id, lists], ["doc_id", "ids"])

    return texts_of(df, id_col, text_col).mapInArrow(lean(run), "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id, decoded`: the bytes that the ids stand for. NULL ids give NULL; an id outside the vocabulary fails."""
    tables = shared_tables(df, path, pattern)

    def run(batches):
        model = ByteBPE(tables.value)
        for batch in batches:
            decoded = [None if ids is None else model.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    ids = df.select(df[id_col].cast("long").alias("doc_id"), df[ids_col].alias("ids"))
    return ids.mapInArrow(lean(run), "doc_id long, decoded binary")


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256`: encodes, decodes the ids again, and returns digests of both.

    The first digest is of the decimal ids joined by one space, the second of the decoded bytes. Ids never leave the
    task, so the result has some hundred bytes a row. Missing values as in `encode`.
    """
    tables = shared_tables(df, path, pattern)

    def run(batches):
        model = ByteBPE(tables.value)
        names = {i: str(i) for i in model.tokens}
        for doc_id, encoded in _encoded(batches, model):
            ids_sha256, decoded_sha256 = [], []
            for ids in map(np.ndarray.tolist, encoded):
                ids_sha256.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded_sha256.append(hashlib.sha256(model.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    doc_id,
                    pa.array([len(ids) for ids in encoded], pa.int64()),
                    pa.array(ids_sha256, pa.string()),
                    pa.array(decoded_sha256, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts_of(df, id_col, text_col).mapInArrow(lean(run), schema)
