"""Near-duplicate documents by an LSH forest of MinHash signatures.

A signature's values are read in several cyclic orders, each starting elsewhere. Sorted by one order, sets with the longest common
prefix stand side by side. In the first passes a row's candidates in an order are the rows of its region: those that share its prefix
down to the depth at which the region has at most REGION rows, so crowded regions go deeper. Candidates whose signatures
differ too much are dropped, the others confirmed on full shingle sets.

Sets that are equal are one node from the start. A first pass confirms one promising partner of every node, which
joins dense groups without all their pairs; MERGES more do so between groups, with a longer sketch of the nodes that have
candidates at all. The last pass takes all nodes and has no limit: regions that still hold several groups are followed up to a depth of
HEAD values, in cells of bounded size. A cell marks the rows that have a candidate there, each pair in the order where its common prefix is
longest; their texts then meet in the cell, neighbours by longest common prefix come first, and pairs that earlier links of the cell have
joined are left out. A cell gives links between groups, fewer than it has rows, and never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise

from .common import lean, pieces_of, texts_of
from .components import components
from .shingles import WordHashes, shingle_set

ORDERS, STEP = 16, 4  # orders, and values between their starts
VALUES = ORDERS * STEP
DEPTH = 12  # values of a sort key
MERGES = 2  # passes that confirm the most similar partner in another group
LONG = 512  # values of the later passes' sketch, 8 bits each
REGION = 64  # rows of a region of the first passes
HEAD = 4  # values that rows compared in the last pass share
CELL, CELL_SHINGLES = 512, 1 << 21  # rows of a crowded region's part, and shingles of their sets
BLOCK, BLOCK_BYTES = 20_000, 32 << 20  # rows held at a time, and their bytes
COMPARED = 8_192  # pairs compared at a time
_ID, _COPY = "__statloom_id", "__statloom_copy"

_random = np.random.default_rng(20)
_FACTORS = _random.integers(1, 1 << 31, VALUES + LONG, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, VALUES + LONG, dtype=np.uint64).astype(np.uint32)
_EQUAL = np.array([(b >> 4 == 0) + (b & 15 == 0) for b in range(256)], dtype=np.uint8)  # equal halves of two bytes, by their difference


def least_values(shingles: np.ndarray, first: int, last: int) -> np.ndarray:
    """MinHash values `first` to `last` of a set of 64-bit hashes, mixed so that all their bits can be used."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(last - first, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 2048):
        block = low[at : at + 2048, None] * _FACTORS[first:last]
        block += _SHIFTS[first:last]
        np.minimum(least, block.min(0), out=least)
    return (least * np.uint32(2654435761)) >> np.uint32(16)


def signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """(16 bits of each MinHash value, 4 bits of each)."""
    least = least_values(shingles, 0, VALUES)
    few = (least & np.uint32(15)).astype(np.uint8)
    return least.astype(">u2").tobytes(), (few[0::2] << 4 | few[1::2]).tobytes()


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, copy, n_shingles, node, signature, sketch`; `copy` is a digest of the text, `node` one of the set, NULL for an empty one."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in pieces_of(batch):
                sets = [shingle_set(t or "", words, hashes) for t in part.column("text").to_pylist()]
                both = [signature(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("copy"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([b[0] for b in both], pa.binary()),
                        pa.array([b[1] for b in both], pa.binary()),
                    ],
                    ["doc_id", "copy", "n_shingles", "node", "signature", "sketch"],
                )

    schema = "doc_id long, copy binary, n_shingles long, node binary, signature binary, sketch binary"
    return texts_of(docs, id_col, text_col).withColumn("copy", _copy(F.col("text"))).mapInArrow(lean(run), schema)


def _copy(text: Column) -> Column:
    """Digest of a text."""
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def region_pairs(tree: np.ndarray, key: np.ndarray, region: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j), i < j, of all pairs that share a region and aren't of one group; rows are sorted by tree and key."""
    n = len(tree)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = (key[1:] == key[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.concatenate([[0], np.cumprod(same, axis=1).sum(1)])  # prefix shared with the row before
    depth = np.full(n, key.shape[1])
    for d in range(key.shape[1], 0, -1):
        number = np.cumsum(common < d) - 1
        depth[np.bincount(number)[number] <= region] = d
    first, second = [], []
    rows = np.arange(n - 1)
    shared = np.full(n - 1, key.shape[1])
    for step in range(1, region + 1):
        inside = rows + step < n
        rows, shared = rows[inside], shared[inside]
        shared = np.minimum(shared, common[rows + step])
        going = shared >= depth[rows]
        rows, shared = rows[going], shared[going]
        if not len(rows):
            break
        told = rows if group is None else rows[group[rows] != group[rows + step]]
        first.append(told)
        second.append(told + step)
    return (np.concatenate(first), np.concatenate(second)) if first else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _blocks(batches, region: int):
    """Sorted rows of a task in blocks, each with the last `region` rows of the one before."""
    held: list[pa.RecordBatch] = []
    rows, old = 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(at, BLOCK))
            rows += held[-1].num_rows
            if rows - old >= BLOCK:
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield table, old
                held = [table.slice(max(0, table.num_rows - region))]
                rows = old = held[0].num_rows
    if rows > old:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], old


def _fixed(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width)


def _pairs(batch: pa.RecordBatch, old: int, least: float, region: int, group: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(i, j, estimated similarity) of the region pairs of a block that may be similar enough and aren't of one group."""
    key = _fixed(batch.column("key"), DEPTH, ">u2")
    sketch = _fixed(batch.column("sketch"), VALUES // 2 if group is None else LONG, "u1")
    first, second = region_pairs(batch.column("tree").to_numpy(), key, region, group)
    fresh = second >= old
    first, second = first[fresh], second[fresh]
    kept = [], [], []
    for at in range(0, len(first), COMPARED):
        i, j = first[at : at + COMPARED], second[at : at + COMPARED]
        if group is None:
            estimate = (_EQUAL[sketch[i] ^ sketch[j]].sum(1) / VALUES - 1 / 16) * 16 / 15
        else:
            estimate = ((sketch[i] == sketch[j]).sum(1) / LONG - 1 / 256) * 256 / 255
        good = estimate >= least
        for out, values in zip(kept, (i, j, estimate)):
            out.append(values[good])
    return tuple(np.concatenate(k) if k else np.zeros(0, dtype=np.int64) for k in kept)


def forest(nodes: DataFrame) -> DataFrame:
    """One row per node and order, dealt by ranges of the key and sorted; further columns are carried along."""
    others = [c for c in nodes.columns if c != "signature"]
    twice = F.concat("signature", "signature")
    rows = nodes.select(*others, twice.alias("twice"), F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"))
    rows = rows.select(*others, "tree", F.expr(f"substring(twice, tree * {2 * STEP} + 1, {2 * DEPTH})").alias("key"))
    return rows.repartitionByRange("tree", "key").sortWithinPartitions("tree", "key", "node")


def best_partners(nodes: DataFrame, threshold: float, least: float) -> DataFrame:
    """`a, b`: for every node with a candidate the most promising one.

    That is the candidate with the most likely links of its own, so that dense groups meet at few nodes; without a likely link the most similar one.
    """

    def run(batches):
        for batch, old in _blocks(batches, REGION):
            i, j, estimate = _pairs(batch, old, least, REGION)
            if not len(i):
                continue
            likely = estimate >= threshold
            degree = np.bincount(i[likely], minlength=batch.num_rows) + np.bincount(j[likely], minlength=batch.num_rows)
            a, b = np.concatenate([i, j]), np.concatenate([j, i])
            worth = np.where(np.tile(likely, 2), 2.0 + degree[b], np.tile(estimate, 2))
            order = np.lexsort((-b, worth, a))
            a, b, worth = a[order], b[order], worth[order]
            last = np.append(a[1:] != a[:-1], True)
            node = batch.column("node")
            yield pa.RecordBatch.from_arrays([node.take(pa.array(a[last])), node.take(pa.array(b[last])), pa.array(worth[last])], ["a", "b", "worth"])

    found = forest(nodes).mapInArrow(lean(run), "a binary, b binary, worth double")
    return found.groupBy("a").agg(F.max(F.struct("worth", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def best_apart(nodes: DataFrame, least: float) -> DataFrame:
    """`a, b`: for every node the most similar candidate of another group."""

    def run(batches):
        for batch, old in _blocks(batches, REGION):
            group = batch.column("group").dictionary_encode().indices.to_numpy()
            i, j, estimate = _pairs(batch, old, least, REGION, group)
            if not len(i):
                continue
            a, b, worth = np.concatenate([i, j]), np.concatenate([j, i]), np.tile(estimate, 2)
            order = np.lexsort((-b, worth, a))
            a, b, worth = a[order], b[order], worth[order]
            last = np.append(a[1:] != a[:-1], True)
            node = batch.column("node")
            yield pa.RecordBatch.from_arrays([node.take(pa.array(a[last])), node.take(pa.array(b[last])), pa.array(worth[last])], ["a", "b", "worth"])

    found = forest(nodes).mapInArrow(lean(run), "a binary, b binary, worth double")
    best = found.groupBy("a").agg(F.max(F.struct("worth", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cells(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Rows of `nodes` by order (`tree`) and region of HEAD values, for regions of several groups, with the `cell` they are compared in
    and the columns that are `carried` there.

    A region of up to CELL rows and CELL_SHINGLES shingles (`length`) is one cell. The rows of a larger one are dealt to parts, those of its
    largest group apart from the others, and every two parts that may hold different groups make a cell: rows of different `side` are
    compared, or all (-1).
    """
    others = carried
    twice = F.concat("signature", "signature")
    rows = nodes.select(*others, twice.alias("twice"), F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"))
    rows = rows.select(*others, "tree", F.expr(f"substring(twice, tree * {2 * STEP} + 1, {2 * HEAD})").alias("head"))
    regions = rows.groupBy("tree", "head", "group").agg(F.count("*").alias("n"), F.sum("length").alias("shingles")).groupBy("tree", "head")
    major = F.max(F.struct("n", "shingles", "group")).alias("major")
    regions = regions.agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), major, F.count("*").alias("groups")).where("groups > 1")

    def parts(n: str, shingles: str) -> Column:
        return F.expr(f"int(greatest(ceil(({n}) / {CELL}), ceil(({shingles}) / {CELL_SHINGLES})))")

    regions = regions.select(
        "tree", "head", F.col("major.group").alias("major"), parts("n", "shingles").alias("n_parts"),
        parts("major.n", "major.shingles").alias("majors"), parts("n - major.n", "shingles - major.shingles").alias("minors"),
    )
    rows = rows.join(regions, ["tree", "head"])
    rows = rows.selectExpr("*", "int(pmod(xxhash64(node), IF(group = major, majors, minors))) AS part")
    met = """CASE WHEN n_parts <= 1 THEN array(struct(0 AS i, 0 AS j, -1 AS side))
        WHEN group = major THEN transform(sequence(0, minors - 1), j -> struct(part AS i, j AS j, 0 AS side))
        ELSE concat(transform(sequence(0, majors - 1), i -> struct(i AS i, part AS j, 1 AS side)),
            transform(sequence(0, minors - 1), k -> struct(majors + least(part, k) AS i, greatest(part, k) AS j, CASE WHEN k = part THEN -1 WHEN part < k THEN 0 ELSE 1 END AS side))) END"""
    rows = rows.select(*others, "tree", "head", F.explode(F.expr(met)).alias("met"))
    rows = rows.select(*others, "tree", F.xxhash64("tree", "head", "met.i", "met.j").alias("cell"), F.col("met.side").alias("side"))
    return rows.repartition("cell").sortWithinPartitions("cell")


def _whole_cells(batches):
    """Sorted rows of a task in blocks that end with a cell."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= BLOCK or size >= BLOCK_BYTES:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cell = table.column("cell").to_numpy()
            end = int(np.searchsorted(cell, cell[-1]))  # cells are sorted as numbers
            if end:
                yield table.slice(0, end)
            held = [table.slice(end)]
            rows, size = held[0].num_rows, held[0].nbytes
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def prefixes(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values that signatures a and b share from the start of each order, up to DEPTH."""
    equal = values[a] == values[b]
    starts = (np.arange(ORDERS)[:, None] * STEP + np.arange(DEPTH)) % VALUES
    return np.cumprod(equal[:, starts], axis=2, dtype=np.int8).sum(axis=2)


def _hits(batch: pa.RecordBatch, least: float, long_least: float | None = None, percent: int = 0):
    """(i, j, common prefix, estimate) of pairs of a cell in different groups that may be similar enough, a few thousand at a time.

    By sizes and the short sketch; with `long_least` also by the long sketch, and only in the order where the two share most values.
    """
    cell, side = batch.column("cell").to_numpy(), batch.column("side").to_numpy()
    group = batch.column("group").dictionary_encode().indices.to_numpy()
    few, length = _fixed(batch.column("few"), VALUES // 2, "u1"), batch.column("length").to_numpy()
    if long_least is not None:
        sketch, tree = _fixed(batch.column("sketch"), LONG, "u1"), batch.column("tree").to_numpy()
        values = _fixed(batch.column("signature"), VALUES, ">u2").astype(np.uint16)
    end = np.searchsorted(cell, cell, side="right")

    def weighed(a: np.ndarray, b: np.ndarray):
        small, large = np.minimum(length[a], length[b]), np.maximum(length[a], length[b])
        estimate = (_EQUAL[few[a] ^ few[b]].sum(1) / VALUES - 1 / 16) * 16 / 15
        good = (estimate >= least) & (100 * small >= percent * large)
        a, b, estimate = a[good], b[good], estimate[good]
        if long_least is None:
            return a, b, estimate, estimate
        estimate = ((sketch[a] == sketch[b]).sum(1) / LONG - 1 / 256) * 256 / 255
        good = estimate >= long_least
        a, b, estimate = a[good], b[good], estimate[good]
        shared = prefixes(values, a, b)
        good = shared.argmax(axis=1) == tree[a]
        return a[good], b[good], shared[good].max(axis=1, initial=0), estimate[good]

    rows, step, waiting, first, second = np.arange(len(cell)), 0, 0, [], []
    while len(rows):
        step += 1
        rows = rows[rows + step < end[rows]]
        told = rows[(group[rows] != group[rows + step]) & ((side[rows] != side[rows + step]) | (side[rows] < 0))]
        first.append(told)
        second.append(told + step)
        waiting += len(told)
        if waiting >= COMPARED or not len(rows):
            i, j = np.concatenate(first), np.concatenate(second)
            for at in range(0, len(i), COMPARED):
                found = weighed(i[at : at + COMPARED], j[at : at + COMPARED])
                if len(found[0]):
                    yield found
            waiting, first, second = 0, [], []


def _marked(batch: pa.RecordBatch, *limits) -> pa.RecordBatch:
    """The rows of a block that have a hit in their cell."""
    mark = np.zeros(batch.num_rows, dtype=bool)
    for i, j, *_ in _hits(batch, *limits):
        mark[i] = mark[j] = True
    return batch.filter(pa.array(mark))


def nodes_apart(nodes: DataFrame, least: float, percent: int) -> DataFrame:
    """`node`: those with a candidate in another group (`group`), by the short sketch `few`."""

    def run(batches):
        for block in _whole_cells(batches):
            found = _marked(block, least, None, percent).column("node").unique()
            yield pa.RecordBatch.from_arrays([found], ["node"])

    return cells(nodes, ["node", "group", "few", "length"]).mapInArrow(lean(run), "node binary").distinct()


def links_apart(nodes: DataFrame, texts: DataFrame, least: float, long_least: float, words: int, percent: int) -> DataFrame:
    """`a, b`: confirmed links that join all groups which a confirmed pair of `nodes` joins.

    Rows that have a candidate by the long sketch get their text, one row for each cell with such a candidate, and the cell confirms: pairs by
    longest common prefix, then by estimate, unless they are joined by then. It gives at most one link fewer than it has rows.
    """
    columns = ["node", "group", "signature", "few", "sketch", "length", "tree", "cell", "side"]

    def mark(batches):
        for block in _whole_cells(batches):
            yield _marked(block, least, long_least, percent).select(columns)

    def confirm(batches):
        hashes = WordHashes()
        for block in _whole_cells(batches):
            cell = block.column("cell").to_numpy()
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            for start, end in zip(starts, [*starts[1:], len(cell)]):
                links = _links(block.slice(start, end - start), hashes, least, long_least, words, percent)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], ["a", "b"])

    rows = cells(nodes, columns[:6])
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    marked = materialise(rows.mapInArrow(lean(mark), schema), "marked")
    whole = marked.join(texts.select("node", "text"), "node").repartition("cell").sortWithinPartitions("cell")
    return whole.mapInArrow(lean(confirm), "a binary, b binary").distinct()


def _links(block: pa.RecordBatch, hashes: WordHashes, least: float, long_least: float, words: int, percent: int) -> list[tuple]:
    """Links of one cell: a tree over the groups that its confirmed pairs join."""
    hits = list(_hits(block, least, long_least, percent))
    if not hits:
        return []
    i, j, shared, estimate = (np.concatenate(c) for c in zip(*hits))
    order = np.lexsort((-estimate, -shared))
    group, node, text = block.column("group").dictionary_encode().indices.to_pylist(), block.column("node"), block.column("text")
    root = list(range(max(group) + 1))
    sets: dict[int, np.ndarray] = {}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def of(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = shingle_set(text[k].as_py() or "", words, hashes)
        return sets[k]

    links = []
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        x, y = top(group[a]), top(group[b])
        if x != y:
            both = len(np.intersect1d(of(a), of(b), assume_unique=True))
            if 100 * both >= percent * (len(of(a)) + len(of(b)) - both):
                root[max(x, y)] = min(x, y)
                links.append((node[a].as_py(), node[b].as_py()))
    return links


def _both_texts(batch: pa.RecordBatch):
    """Pieces bounded by both texts of their rows."""
    for part in pieces_of(batch, "text_a"):
        yield from pieces_of(part, "text_b")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity: 100 * intersection >= percent * union."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in _both_texts(batch):
                sets: dict[bytes, np.ndarray] = {}
                good = []
                for a, b, s, t in zip(*(part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                    for node, text in ((a, s), (b, t)):
                        if node not in sets:
                            sets[node] = shingle_set(text, words, hashes)
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    good.append(100 * both >= percent * (len(sets[a]) + len(sets[b]) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    joined = joined.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(lean(run), "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row.

    Rows whose sets of `words`-word shingles have a similarity of `percent` hundredths or more are linked; `component_id` is the smallest id
    reachable, `kept` marks the row that has it. Each link is confirmed on full sets. A pair exactly at 0.8 shares four
    values at the start of some order with a chance of 0.9998, a closer one with more; all pairs that do are compared or already of one
    group, however many rows share the values.

    Empty or NULL texts are linked with nothing. Rows with a NULL id take no part: their component is NULL and they are kept. Rows
    that repeat an id belong to the same document only as far as their texts agree, and such rows are kept or not together.
    Other columns are not looked at; an empty table gives an empty one.
    """
    return _decided(docs, words, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _decided(docs: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`near_duplicates` with the `copy` and `node` of every row and the `root`, a node that stands for its group."""
    threshold = percent / 100
    # 4.6 standard deviations of the estimate from VALUES half bytes, and from LONG bytes
    least, long_least = threshold - 0.24, threshold - 0.082
    table = materialise(signatures(docs, words, id_col, text_col), "signatures")
    nodes = table.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
    nodes = materialise(nodes.agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("length")), "nodes")

    partners = materialise(best_partners(nodes.drop("doc_id"), threshold, least), "partners")
    members = nodes.join(partners.select(F.col("a").alias("node")), "node", "left_semi")
    members = materialise(members, "members")
    texts = texts_of(docs, id_col, text_col).join(members.select("doc_id", "node"), "doc_id").select("node", "text")
    texts = materialise(of_their_node(texts, words).dropDuplicates(["node"]), "texts")
    first = partners.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialise(confirmed(first, texts, words, percent), "first-links")
    groups = components(links, "first-groups")

    members = materialise(members.select("node", "signature").join(texts.select("node", "sketch"), "node"), "sketches")
    for turn in range(MERGES):
        more = confirmed(best_apart(_grouped(members, groups), long_least), texts, words, percent)
        groups = components(more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))), f"groups-{turn}")
    short = nodes.select("node", "signature", F.col("sketch").alias("few"), "length")
    apart = materialise(nodes_apart(_grouped(short, groups), least, percent), "apart")
    late = materialise(nodes.join(apart, "node").join(members, "node", "left_anti").select("doc_id", "node"), "late")
    if not late.isEmpty():  # their likely partners were hidden in crowded regions
        more_texts = texts_of(docs, id_col, text_col).join(late, "doc_id").select("node", "text")
        texts = texts.unionByName(materialise(of_their_node(more_texts, words).dropDuplicates(["node"]), "late-texts"))
    last = short.join(apart, "node").join(texts.select("node", "sketch"), "node")
    rest = links_apart(_grouped(last, groups), texts, least, long_least, words, percent)
    stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = components(rest.unionByName(stars), "groups")

    grouped = nodes.select("node", "doc_id").join(groups, "node")
    least_id = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # the smallest node of a component is not itself in `groups`
    roots = least_id.join(nodes.select(F.col("node").alias("component"), F.col("doc_id").alias("root_id")), "component")
    roots = roots.select("component", F.least("component_id", "root_id").alias("component_id"))
    of_node = groups.join(roots, "component").select("node", "component_id", F.col("component").alias("root"))
    of_node = of_node.unionByName(roots.select(F.col("component").alias("node"), "component_id", F.col("component").alias("root")))
    named = nodes.select("node", "doc_id").join(of_node, "node", "left")
    named = named.select("node", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("root", "node").alias("root"))
    out = table.select("doc_id", "copy", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "copy", "n_shingles", "node", "root", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _grouped(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The nodes with their group so far; a node without a link is a group."""
    return members.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")


def of_their_node(texts: DataFrame, words: int) -> DataFrame:
    """One text per node with its long sketch; rows that repeat an id may hold other texts too, which go, or the same again."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in pieces_of(batch):
                sets = [shingle_set(t or "", words, hashes) for t in part.column("text").to_pylist()]
                same = [xxhash.xxh3_128_digest(s.tobytes()) == n for s, n in zip(sets, part.column("node").to_pylist())]
                sketch = [least_values(s, VALUES, VALUES + LONG).astype(np.uint8).tobytes() if k else None for s, k in zip(sets, same)]
                part = pa.RecordBatch.from_arrays([part.column("node"), part.column("text"), pa.array(sketch, pa.binary())], ["node", "text", "sketch"])
                yield part.filter(pa.array(same, pa.bool_()))

    return texts.mapInArrow(lean(run), "node binary, text string, sketch binary")


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns, and of a group just one.

    Rows are told apart by id and text. Where several rows of a group have its smallest id, one of them stays. Empty or NULL
    texts and rows with a NULL id all stay.
    """
    rows = _decided(docs, words, percent).where("doc_id IS NOT NULL AND node IS NOT NULL")
    rows = materialise(rows.select("doc_id", "copy", "root", "kept"), "decided")
    several = rows.where("kept").groupBy("root", "doc_id").agg(F.count("*").alias("n"), F.min("copy").alias("stays")).where("n > 1")
    several = materialise(several, "several")
    again = rows.where("kept").join(several.select("root", "doc_id"), ["root", "doc_id"])
    gone = rows.where("NOT kept").unionByName(again).select(F.col("doc_id").alias(_ID), F.col("copy").alias(_COPY)).distinct()
    keyed = docs.withColumns({_ID: F.col("doc_id").cast("long"), _COPY: _copy(F.col("text"))})
    out = keyed.join(gone, [_ID, _COPY], "left_anti")
    if not several.isEmpty():
        stays = several.select(F.col("doc_id").alias(_ID), F.col("stays").alias(_COPY))
        out = out.unionByName(keyed.join(stays, [_ID, _COPY], "left_semi").dropDuplicates([_ID, _COPY]))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
