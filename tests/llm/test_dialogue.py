"""Conversation repair against plain code: a walk over all edits, and a full interval chart."""

import hashlib
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from statloom.llm import dialogue
from statloom.llm.catalog import QUERIES

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(way, 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    return out


def cheapest(rows, faults):
    """Least (cost, audit, repaired) by going through rows and situations one by one."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(states):
        for _ in range(4):
            more = dict(states)
            for s, (cost, audit, kept) in states.items():
                for role in ("user", "assistant"):
                    t = steps.get((s, role[0]))
                    if t:
                        option = (cost + 5, audit + "I", (*kept, f"{role}:"))
                        if t not in more or option[:2] < more[t][:2]:
                            more[t] = option
            states = more
        return states

    states = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def offer(s, option, after=after):
            if s not in after or option[:2] < after[s][:2]:
                after[s] = option

        for s, (cost, audit, kept) in states.items():
            offer(s, (cost + 2, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if (s, role[:1]) in steps:
                offer(steps[s, role[:1]], (cost + extra, audit + "K", (*kept, f"{role}:{text}")))
            for other in ("user", "assistant"):
                if (s, other[0]) in steps:
                    offer(steps[s, other[0]], (cost + extra + 1, audit + "R", (*kept, f"{other}:{text}")))
        states = inserted(after)
    return min(states[s] for s in ("", "a") if s in states)


def expected(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, kept = cheapest(rows, faults)
    return {
        "gaps": gaps,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    }


def check(found, rows):
    conversations = {}
    for r in rows:
        conversations.setdefault(r[0], []).append(r)
    found = {r["conv_id"]: r.asDict() for r in found.collect()}
    assert set(found) == set(conversations)
    for conv, its in conversations.items():
        assert found[conv] == {"conv_id": conv, **expected(damage(its))}, conv


def test_query_over_the_whole_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_conversation_repair"](spark, data), rows)


def test_nulls_blanks_ties_and_clashing_columns(spark):
    rows = [(None, 0, "user", "a."), (None, None, None, None), (1, None, "user", "x."), (1, None, "user", "x."), (1, None, "assistant", "x")]
    rows += [(2, 5, "", "kept?"), (2, 5, "tool", "kept?"), (2, 2**40, "assistant", "\t\n"), (3, 0, "user", "say \x0b"), (4, 1, "system", "s.")]
    rows += [(5, t, ("user", "assistant")[t % 2], "long " * 30_000 + f"{t}.") for t in range(3)]
    rows += [(6, t, "user", "hm.") for t in range(9)] * 3 + [(7, 10 - t, "user" if t % 2 else "assistant", f"{t}.") for t in range(10)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select(*df.columns, F.lit(1).alias("copies"), F.lit("z").alias("digest"), F.lit(2).alias("first"))
    for parts in (1, 7):
        check(dialogue.repair_digests(dialogue.damaged(df.repartition(parts))), rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.repair_digests(dialogue.damaged(df)).collect() == []


def test_a_conversation_over_many_tasks(spark):
    rows = [(1, t, ("user", "assistant", "user")[t % 3], f"{t % 5000} {'.' if t % 11 else ''}") for t in range(20_000)] + [(2, 0, "user", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    check(dialogue.repair_digests(dialogue.damaged(df)), rows)


def chart(letters):
    """All spans by length, all split points."""
    n = len(letters)
    cells = {(i, i + 1): dialogue.ROWS[c] for i, c in enumerate(letters)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = {}
            for k in range(i + 1, i + length):
                for key, value in dialogue.joined(cells[i, k], cells[k, i + length]).items():
                    cell[key] = min(value, cell.get(key, value))
            cells[i, i + length] = cell
    whole = cells[0, n] if n else dialogue.EMPTY
    return min(whole["0", q] for q in dialogue.ENDS if ("0", q) in whole)


@pytest.mark.parametrize("length", range(5))
def test_aligned_spans_equal_the_full_chart(length):
    alphabet = dialogue.SOUND + "U" + "2"
    for letters in product(alphabet, repeat=length):
        assert dialogue.parse("".join(letters)) == chart("".join(letters))
