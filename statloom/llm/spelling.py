"""Grouping of spelling variants: words one edit apart, each pointing to its clearly more frequent neighbour.

Near words are found by dynamic programming over sorted lists. Rows of the edit matrix, cut to a band of three, belong to the
prefixes that adjacent words share: a prefix of depth d is a range of the list, its row is made once from the row of its first d - 1
letters and serves every word of the range, and a range whose row exceeds one edit is skipped whole. All words of a list ask at the
same time, depth by depth, on numpy arrays.

Lists are short. Two words one edit apart, the shorter one of L letters, differ first at one position p of 0 .. L. Positions are
dealt into regions; words that agree before and behind a region share its list, and p names the one region where a pair
counts. A list longer than `limit` is dealt again by both halves of its region, which ends at one position: there the words share
all but two letters at most, so the alphabet bounds the list. Nothing is capped, and no pair becomes a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise

LETTERS = r"[A-Za-zÀ-ÿ]+"
LIMIT = 128  # words of a list before its region is halved
BLOCK_WORDS, BLOCK_CELLS = 8_000, 1 << 21  # what a task works on at a time
FAR = 9
KEY = ["size", "lo", "hi", "around"]


def runs_of(df: DataFrame, modulus: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of letters, A-Z lower-cased. Where `modulus` divides the crc32 of `<id>:<run>`, one letter is gone: the one
    at position crc32 % length. 0 leaves runs alone. A NULL text has no runs, a NULL id counts as an empty one."""
    texts = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = texts.select("id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    run, upper = F.col("run"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = found.select("id", F.when(F.lower(run) == run, run).otherwise(F.translate(run, upper, upper.lower())).alias("run"))
    if not modulus:
        return found.select(F.col("run").alias("word"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.select(F.when(h % modulus == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """`word, n` of the words with enough letters and occurrences."""
    counted = words.where(F.char_length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def _placed(members: DataFrame, regions: Column) -> DataFrame:
    """Members of the lists of the given regions `(size, lo, hi)`: words that agree before lo and in their last size - hi letters."""
    dealt = members.select("word", "n", F.inline(regions))
    behind = F.col("size") - F.col("hi")
    before = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    after = F.when(behind > 0, F.substring(F.col("word"), F.char_length("word") - behind + 1, behind)).otherwise("")
    return dealt.select("word", "n", "size", "lo", "hi", F.xxhash64(before, F.lit("|"), after).alias("around"))


def _halves(size: Column, lo: Column, hi: Column) -> Column:
    middle = F.floor((lo + hi) / 2).cast("int")
    parts = [(lo, middle), (middle, hi)]
    return F.array(*[F.struct(size.alias("size"), a.alias("lo"), b.alias("hi")) for a, b in parts])


def lists(words: DataFrame, limit: int = LIMIT, least_letters: int = 5) -> list[DataFrame]:
    """Tables `size, lo, hi, members`, one row a list, that together hold every near pair in exactly one list as `near_in` counts it."""
    m = F.char_length("word")
    sizes = F.when(m > least_letters, F.array(m, m - 1)).otherwise(F.array(m))
    start = words.select("word", "n", F.explode(sizes).alias("size"))
    level = _placed(start, _halves(F.col("size"), F.lit(0), F.col("size") + 1))
    tables = []
    while True:
        level = materialise(level, "spelling-lists")
        long = level.groupBy(*KEY).count().where((F.col("count") > limit) & (F.col("hi") - F.col("lo") > 1)).drop("count")
        long = materialise(long, "spelling-long")
        rest = level.join(long, KEY, "left_anti")
        gathered = rest.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("members"))
        tables.append(gathered.where(F.size("members") > 1).drop("around"))
        if long.isEmpty():
            return tables
        level = _placed(level.join(long, KEY, "left_semi"), _halves(F.col("size"), F.col("lo"), F.col("hi")))


def near_pairs(codes: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered pairs (asking word, word) exactly one edit apart, within groups. Words are rows of code points, sorted by group and
    word, with zeros behind them and at least two columns of zeros at the end."""
    n, width = codes.shape
    differ = codes[1:] != codes[:-1]
    shared = np.where(group[1:] == group[:-1], differ.argmax(axis=1), -1)
    shared = np.concatenate([[-1], shared])
    bounds = np.append(np.flatnonzero(shared < 0), n)
    member = np.searchsorted(bounds, np.arange(n), side="right") - 1
    q, start, end = np.arange(n), bounds[member], bounds[member + 1]
    v0, v1, v2 = np.full(n, FAR, np.int8), np.zeros(n, np.int8), np.ones(n, np.int8)
    found = []
    for depth in range(width - 1):
        opens = shared <= depth
        starts = np.append(np.flatnonzero(opens), n)
        before = np.concatenate([[0], np.cumsum(opens)])
        first = before[start]
        children = before[end] - first
        parent = np.repeat(np.arange(len(q)), children)
        child = np.arange(len(parent)) - np.repeat(np.cumsum(children) - children, children) + first[parent]
        start, end, q = starts[child], starts[child + 1], q[parent]
        v0, v1, v2, letter = v0[parent], v1[parent], v2[parent], codes[start, depth]
        over = letter == 0
        if over.any():
            asked, ended = q[over], start[over]
            gap = sizes[asked] - depth
            value = np.select([gap == -1, gap == 0, gap == 1], [v0[over], v1[over], v2[over]], FAR)
            found.append((asked[value == 1], ended[value == 1]))
        n0 = v1 + 1 if depth == 0 else np.minimum(v1 + 1, v0 + (letter != codes[q, depth - 1]))
        n1 = np.minimum(np.minimum(v2 + 1, v1 + (letter != codes[q, depth])), n0 + 1)
        n2 = np.minimum(v2 + (letter != codes[q, depth + 1]), n1 + 1)
        alive = ~over & (np.minimum(np.minimum(n0, n1), n2) <= 1)
        q, start, end = q[alive], start[alive], end[alive]
        v0, v1, v2 = (np.minimum(v[alive], FAR).astype(np.int8) for v in (n0, n1, n2))
        if not len(q):
            break
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _first_difference(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    step = max(1, BLOCK_CELLS // codes.shape[1])
    parts = [(codes[a[i : i + step]] != codes[b[i : i + step]]).argmax(axis=1) for i in range(0, len(a), step)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def near_in(words: list[str], n: np.ndarray, group: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple:
    """Per word with near words in its list: its place, their number, and the place of the most frequent one (ties: the first).

    A pair counts where the shorter word has `size` letters and the first difference lies in lo .. hi - 1.
    """
    sizes = np.array([len(w) for w in words])
    width = int(sizes.max()) + 2
    codes = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    a, b = near_pairs(codes, sizes, group)
    at = _first_difference(codes, a, b)
    counts = (np.minimum(sizes[a], sizes[b]) == size[a]) & (at >= lo[a]) & (at < hi[a])
    a, b = a[counts], b[counts]
    order = np.lexsort((b, -n[b], a))
    a, b = a[order], b[order]
    place, first, number = np.unique(a, return_index=True, return_counts=True)
    return place, number, b[first]


def _near(batches):
    names = ["word", "near", "form_n", "form"]

    def answers(batch):
        members = batch.column("members")
        sizes = members.value_lengths().to_numpy(zero_copy_only=False)
        flat = members.flatten()
        words, n = flat.field("word").to_pylist(), flat.field("n").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        size, lo, hi = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("size", "lo", "hi"))
        place, number, best = near_in(words, n, row, size, lo, hi)
        columns = [pa.array([words[i] for i in place], pa.string()), pa.array(number), pa.array(n[best])]
        return pa.RecordBatch.from_arrays([*columns, pa.array([words[i] for i in best], pa.string())], names)

    for batch in batches:
        start = held = longest = 0
        lengths = batch.column("members").value_lengths().to_pylist()
        letters = pa.compute.add(batch.column("size"), 3).to_pylist()
        for i, (k, m) in enumerate(zip(lengths, letters)):
            longest = max(longest, m)
            if i > start and (held + k > BLOCK_WORDS or (held + k) * longest > BLOCK_CELLS):
                yield answers(batch.slice(start, i - start))
                start, held, longest = i, 0, m
            held += k
        if start < batch.num_rows:
            yield answers(batch.slice(start))


def near_words(words: DataFrame, limit: int = LIMIT, least_letters: int = 5) -> DataFrame:
    """`word, n_near, form_n, form` of every word with a near word: their number, and the most frequent one (ties: smallest)."""
    schema = "word string, near long, form_n long, form string"
    parts = [t.mapInArrow(_near, schema) for t in lists(words, limit, least_letters)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), "form")).alias("best")
    summed = whole.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("best.rank")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """`word, root` for the links `word, form`: the last word of each chain. Links are doubled each turn, so chains of k links take
    log k turns; as counts at least double along a chain, a few do."""
    current = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(current.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return current


def spelling_groups(words: DataFrame, ratio: int = 2, limit: int = LIMIT, least_letters: int = 5) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for the vocabulary `word, n`.

    `form` is the near word with the largest n (ties: smallest in code-point order) if that is at least `ratio` times the word's own,
    else NULL; `root` follows forms to the last. `ratio` must exceed 1. An empty vocabulary gives an empty table.
    """
    words = materialise(words, "spelling-words")
    near = near_words(words, limit, least_letters)
    known = words.join(near, "word", "left")
    clear = F.col("form_n") >= F.col("n") * ratio
    known = known.select(
        "word", F.when(clear, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(clear, F.col("form_n")).alias("form_n")
    )
    known = materialise(known, "spelling-forms")
    ends = roots(known.where(F.col("form").isNotNull()))
    whole = known.join(ends, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
