"""Repair of the structure of conversations by weighted interval parsing.

A repaired conversation reads `(s?(ua)+)?` by the first letters of its roles. Every row is kept, given another role or deleted, and
rows with an empty text may be inserted, each edit at a price. The grammar is in Chomsky normal form: a nonterminal `(p, q)` stands
for a piece of conversation that leads from situation p to situation q, its binary rules are `(p, r) -> (p, q) (q, r)`, its
terminal rules are the edits of one row, and insertions are a closure around each row. A cell holds, per nonterminal, the least
`(cost, audit)`, the audit being the initials of the edits in order.

Cells are combined bottom-up by span length. As any split point of a span gives the same least cell (an audit fixes its cost, so of two
audits of equal cost neither begins the other, and the order of concatenations is that of their parts), only aligned spans
of 1, 2, 4, ... rows are filled: n log n instead of n ** 3 steps.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise

from .common import pieces_of

RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # prices; keeping is free
BLOCK_BITS = 12  # rows of a conversation are gathered in blocks of at most 4096 letters' rows
REMEMBERED = 100_000  # short conversations whose parse a task remembers
SHORT = 64

# Situations: 0 nothing yet, s after system, u after user, a after assistant.
STEPS = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
ENDS = ("0", "a")
Cell = dict[tuple[str, str], tuple[int, str]]

# Letters of rows by the initial of their role: sound, must go (blank or duplicate), truncated. x is any other initial.
SOUND, GONE, CUT = "suax", "SUAX", "1234"
LETTERS = {c: (i, kind) for kind, row in (("sound", SOUND), ("gone", GONE), ("cut", CUT)) for c, i in zip(row, SOUND)}
INITIALS = str.maketrans(GONE + CUT, SOUND + SOUND)


def joined(left: Cell, right: Cell) -> Cell:
    """The least cell of two neighbouring spans: all rules `(p, r) -> (p, q) (q, r)`."""
    out: Cell = {}
    for (p, q), (cost, audit) in left.items():
        for (q2, r), (more, rest) in right.items():
            if q == q2:
                known = out.get((p, r))
                if known is None or cost + more < known[0]:
                    out[p, r] = (cost + more, audit + rest)
                elif cost + more == known[0]:
                    out[p, r] = min(known, (cost + more, audit + rest))
    return out


def _insertions() -> Cell:
    """Cell of a span without rows: nothing, or user and assistant rows put in. No row is ever worth a fourth one."""
    cell = nothing = {(p, p): (0, "") for p in "0sua"}
    one = nothing | {(p, q): (INSERT, "I") for (p, i), q in STEPS.items() if i != "s"}
    for _ in range(3):
        cell = joined(cell, one)
    return cell


EMPTY = _insertions()


def _row_cell(letter: str) -> Cell:
    """Cell of one row with any insertions around it."""
    initial, kind = LETTERS[letter]
    edits: Cell = {(p, p): (DELETE, "D") for p in "0sua"}
    if kind != "gone":
        extra = TRUNCATED if kind == "cut" else 0
        for (p, i), q in STEPS.items():
            options = [(extra, "K")] * (i == initial) + [(RETITLE + extra, "R")] * (i != "s")
            if options:
                edits[p, q] = min([*options, edits.get((p, q), options[0])])
    return joined(joined(EMPTY, edits), EMPTY)


ROWS = {letter: _row_cell(letter) for letter in LETTERS}


def parse(letters: str) -> tuple[int, str]:
    """Least cost and its ASCII-least audit for the rows written as letters."""
    spans = [ROWS[c] for c in letters] or [EMPTY]
    while len(spans) > 1:
        pairs = [joined(a, b) for a, b in zip(spans[::2], spans[1::2])]
        spans = pairs + spans[len(spans) & ~1 :]
    return min(spans[0]["0", q] for q in ENDS if ("0", q) in spans[0])


def illegal_pairs(letters: str) -> int:
    """Neighbouring rows whose initials are none of su, ua, au."""
    initials = letters.translate(INITIALS)
    return sum(n for pair, n in Counter(zip(initials, initials[1:])).items() if "".join(pair) not in ("su", "ua", "au"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def rows_of(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Fixed names for the columns in use. NULL roles and texts are one space; `copies` says how often a row stands there."""
    return df.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text: `first` and `rest` are the letters of its first copy and of each further one.

    Only digests of texts are shuffled. Copies are counted before the shuffle, so a row repeated any number of times is one row. The
    first turn of a text is an aggregate, joined back; Spark splits that join where one text fills a table.
    """
    solid = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    held = rows.select(
        "conv_id",
        F.when(F.col("copies") > 0, F.col("turn")).alias("turn"),
        F.when(F.col("copies") > 0, F.col("role")).alias("role"),
        F.when(F.col("copies") > 0, F.unhex(F.md5(F.col("text").cast("binary")))).alias("digest"),
        F.when(F.col("copies") > 0, solid == "").alias("blank"),
        F.when(F.col("copies") > 0, ~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("truncated"),
        "copies",
    )
    counted = held.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    seen = counted.where("copies > 0").groupBy("conv_id", "role", "digest").agg(
        F.bool_or(F.col("turn").isNull()).alias("at_null"), F.min("turn").alias("at")
    )
    seen = seen.select(*[F.col(c).alias(f"_{c}") for c in seen.columns])
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    both = counted.join(seen, same, "left")
    earliest = F.when(F.col("_at_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("_at"))
    initial = _initial(F.col("role"))
    gone = F.translate(initial, SOUND, GONE)
    first = F.when(F.col("blank") | ~earliest, gone).when(F.col("truncated"), F.translate(initial, SOUND, CUT)).otherwise(initial)
    return both.select("conv_id", "turn", "role", "digest", "blank", "copies", first.alias("first"), gone.alias("rest"))


def _letters(found: DataFrame) -> DataFrame:
    """`conv_id, letters`: the rows of each conversation in order, one letter each.

    Rows are dealt by ranges of (conversation, turn, role, digest), so a very long conversation lies in many tasks; blocks of
    at most 4096 rows become strings first, and only those strings meet by conversation: a letter for each row, as long as the audit.
    """
    order = ["conv_id", "turn", "role", "digest"]
    ordered = found.where("copies > 0").repartitionByRange(*order).sortWithinPartitions(*order)
    word = F.concat("first", F.repeat("rest", (F.col("copies") - 1).cast("int")))
    placed = ordered.select("conv_id", F.monotonically_increasing_id().alias("at"), word.alias("word"))

    def strung(df: DataFrame, *keys) -> DataFrame:
        listed = df.groupBy("conv_id", *keys).agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("l"))
        return listed.select("conv_id", F.element_at("l", 1)["at"].alias("at"), F.array_join(F.col("l.word"), "").alias("word"))

    blocks = strung(placed, F.shiftright("at", BLOCK_BITS).alias("block"))
    return strung(blocks).select("conv_id", F.col("word").alias("letters"))


def report(rows: DataFrame) -> DataFrame:
    """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`, one row per conversation of `rows`, also those without a row left.

    Rows go by turn, NULL turns first, then role and the MD5 of the text; a NULL conv_id is a conversation of its own. The first fault of a row
    counts: blank, seen earlier with role and text, not ended by `.`, `!` or `?`. `gaps` is NULL where turns span more than a long.
    An empty table gives an empty one.
    """
    found = faults(rows)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    n, first = F.col("copies"), F.col("first")
    repeated = F.when(F.col("blank"), 0).when(first == F.col("rest"), n).otherwise(n - 1)
    stats = found.groupBy("conv_id").agg(
        F.min("turn").alias("lo"),
        F.max("turn").alias("hi"),
        F.count_distinct("turn").alias("turns"),
        total(F.when(F.col("blank"), n)).alias("blank"),
        total(F.when(n > 0, repeated)).alias("duplicate"),
        total(F.when(first.isin(*CUT), 1)).alias("truncated"),
    )
    gaps = F.when(F.col("lo").isNull(), F.lit(0).cast("long")).otherwise(
        F.try_subtract(F.try_add(F.try_subtract("hi", "lo"), F.lit(1).cast("long")), F.col("turns"))
    )
    letters = _letters(found).withColumnRenamed("conv_id", "_conv_id")
    whole = stats.join(letters, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left")
    whole = whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", F.coalesce("letters", F.lit("")).alias("letters"))

    def run(batches):
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for letters in batch.column("letters").to_pylist():
                result = known.get(letters)
                if result is None:
                    result = (illegal_pairs(letters), *parse(letters))
                    if len(letters) <= SHORT and len(known) < REMEMBERED:
                        known[letters] = result
                out.append(result)
            illegal, cost, audit = (list(c) for c in zip(*out)) if out else ([], [], [])
            kept = [batch.column(c) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(illegal, pa.int64()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())], names
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return whole.mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """`conv_id, position, edit, role, text`: the rows of every repaired conversation, in order within each task.

    Each conversation's audit is put before its rows, and a task walks through both, so it holds one batch and one audit.
    A conversation stays in one task here, as its rows follow each other.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    present = rows.where("copies > 0").select(
        "conv_id", F.lit(True).alias("row"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text", "copies"
    )
    heads = reports.select("conv_id", F.lit(False).alias("row"), F.col("audit").alias("text"))
    stream = present.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
    stream = stream.sortWithinPartitions("conv_id", "row", "turn", "role", "digest").select("conv_id", "row", "role", "copies", "text")

    def run(batches):
        conv, audit, at, position, last = None, "", 0, 0, ""
        out: list[tuple] = []

        def put(edit, role, text):
            nonlocal position, last
            if role is None:
                role = "assistant" if last == "u" else "user"
            out.append((conv, position, edit, role, text))
            position, last = position + 1, role[:1]

        def insertions():
            nonlocal at
            while audit[at : at + 1] == "I":
                put("I", None, "")
                at += 1

        def taken():
            columns = list(zip(*out)) or [()] * 5
            kinds = [field.type for field in result_types]
            result = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.name for f in result_types])
            out.clear()
            return result

        result_types = None
        for batch in batches:
            if result_types is None:
                names = [("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
                result_types = pa.schema([("conv_id", batch.schema.field("conv_id").type), *names])
            for piece in pieces_of(batch):
                for c, is_row, role, copies, text in zip(*(piece.column(i).to_pylist() for i in range(5))):
                    if not is_row:
                        insertions()
                        conv, audit, at, position, last = c, text, 0, 0, ""
                        continue
                    for _ in range(copies):
                        insertions()
                        edit, at = audit[at], at + 1
                        if edit != "D":
                            put(edit, role if edit == "K" else None, text)
                yield taken()
        insertions()
        if out:
            yield taken()

    return stream.mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """`conv_id, repaired_sha256` of `role:text` joined by newlines, over the rows as `repaired` leaves them in each task."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, state, type_ = None, None, None
        for batch in batches:
            type_ = batch.schema.field("conv_id").type
            ids, sums = [], []
            for piece in pieces_of(batch):
                columns = (piece.column(c).to_pylist() for c in ("conv_id", "position", "role", "text"))
                for c, position, role, text in zip(*columns):
                    if position == 0:
                        if state is not None:
                            ids.append(conv)
                            sums.append(state.hexdigest())
                        conv, state = c, hashlib.sha256()
                    state.update(f"{role}:{text}".encode() if position == 0 else f"\n{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, type_), pa.array(sums, pa.string())], ["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], type_), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    return turns.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by crc32(`conv_id:turn`) % 20: 0 drops the row, 1 empties its text, 2 removes its `.`, `!` and `?`, 3 repeats it,
    4 makes it the user's. NULLs count as one space, also in the key. A dropped row stays with no copies."""
    rows = rows_of(df, conv_col, turn_col, role_col, text_col)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    way = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    text = F.when(way == 1, "").when(way == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role, copies = F.when(way == 4, "user").otherwise(F.col("role")), F.when(way == 0, 0).when(way == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report and repaired rows of `rows` (see `rows_of`). The report, a letter for each row, is written once, as both results read it."""
    written = materialise(report(rows), "dialogue")
    return written, repaired(rows, written)


def repair_digests(rows: DataFrame) -> DataFrame:
    """The report with `repaired_sha256`; a conversation without rows has the hash of the empty string."""
    reports, turns = repair(rows)
    sums = digests(turns).withColumnRenamed("conv_id", "_conv_id")
    whole = reports.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(*reports.columns, F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
