"""Secrets in text: fixed patterns, and a small character convolution network over every other candidate with its context.

Candidates are long unbroken runs of key characters with a letter and a digit; a run that a pattern takes in part leaves its other parts. The network sees a window of the run and the text
around it. It is trained on the findings of the fixed patterns in all documents and on keys in
public formats, against plainly everyday runs of all documents and harmless runs in public formats. Other runs that no pattern takes may be
keys of any kind: they have no label and take no part. The threshold is the highest that
still finds a required share of the secrets of a part the network wasn't trained on.

Findings are dealt by a hash to parts of about PART. A pass of training walks through every part from the same network, in mini-batches, and the
networks of the parts are averaged by their rows before the next pass. With a single part that is plain training.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order_stats import order_statistics
from .common import give_back, lean, pieces_of, text_slices, texts_of
from .labelled import calibrated, fit_isotonic_table

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "network")

# A piece between signs that is words or a number, with up to four digits after the words.
EVERYDAY = re.compile(r"([a-z]{1,20}|[A-Z]{1,10}|([A-Z][a-z]+){1,4})?[0-9]{0,4}|[0-9]{1,11}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
SIDE, RUN = 16, 48  # characters of context on either side, and of the run in one window
WIDTH = 2 * SIDE + RUN
CLASSES = 128

PART = 1000  # findings of a part; each part has its own runs in public formats, so that their share stays as findings grow
FORMATS = 150  # runs of each public format in a part
JOINED = 64  # networks of parts that one task averages
FINDING = "before string, run string, after string, label int"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and without overlap per kind, in code points."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs with a letter and a digit, or what the spans leave of them, without the dots and signs at their ends."""
    found = []
    spans = sorted((a, b) for a, b, _ in taken)
    first = 0
    for m in CANDIDATE.finditer(text):
        while first < len(spans) and spans[first][1] <= m.start():
            first += 1
        left, at = [], m.start()
        for k in range(first, len(spans)):
            a, b = spans[k]
            if a >= m.end():
                break
            left.append((at, a))
            at = max(at, b)
        for begin, stop in [*left, (at, m.end())]:
            run = text[begin:stop]
            start = begin + len(run) - len(run.lstrip("=.-/"))
            end = begin + len(run.rstrip(".-/"))
            if end - start >= 16 and any(c.isdigit() for c in text[start:end]) and any(c.isalpha() for c in text[start:end]):
                found.append((start, end))
    return found


def everyday(run: str) -> bool:
    """Whether all pieces between signs are words or numbers, so that the run is surely no key."""
    return all(EVERYDAY.fullmatch(piece) for piece in re.split(r"[+/_.=-]", run))


def windows(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """Character classes of the run, piece by piece, with the context on both sides."""
    for at in range(start, max(end - RUN // 2, start + 1), RUN):
        stop = min(at + RUN, end)
        shown = text[max(at - SIDE, 0) : at].rjust(SIDE, "\0") + text[at:stop].ljust(RUN, "\0") + text[stop : stop + SIDE].ljust(SIDE, "\0")
        yield np.minimum(np.frombuffer(shown.encode("utf-32-le"), dtype=np.uint32), CLASSES - 1)


class Network:
    """Embedding, one convolution, the largest answer inside the run and around it, one linear layer."""

    def __init__(self, seed: int = 1, size: int = 8, filters: int = 24, reach: int = 5):
        random = np.random.default_rng(seed)
        self.reach = reach
        self.parts = {
            "embedding": random.normal(0, 0.5, (CLASSES, size)),
            "filters": random.normal(0, (2 / (reach * size)) ** 0.5, (reach * size, filters)),
            "shift": np.zeros(filters),
            "last": random.normal(0, 0.1, 2 * filters),
            "bias": np.zeros(1),
        }
        at = np.arange(WIDTH - reach + 1) + reach // 2
        self.inside = (at >= SIDE) & (at < SIDE + RUN)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        p = self.parts
        shown = p["embedding"][x]
        patches = np.lib.stride_tricks.sliding_window_view(shown, self.reach, axis=1)  # rows, places, size, reach
        patches = patches.transpose(0, 1, 3, 2).reshape(len(x), -1, p["filters"].shape[0])
        answers = np.maximum(patches @ p["filters"] + p["shift"], 0)
        pooled, best = [], []
        for part in (self.inside, ~self.inside):
            places = np.flatnonzero(part)
            top = answers[:, places].argmax(1)
            best.append(places[top])
            pooled.append(np.take_along_axis(answers, best[-1][:, None, :], 1)[:, 0])
        pooled = np.concatenate(pooled, 1)
        return pooled @ p["last"] + p["bias"][0], (patches, pooled, best)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        raw, (patches, pooled, best) = self.forward(x)
        error = (1 / (1 + np.exp(-raw)) - y) / len(y)
        p, n = self.parts, self.parts["shift"].size
        out = {k: np.zeros_like(v) for k, v in p.items()}
        out["last"], out["bias"] = pooled.T @ error, np.array([error.sum()])
        back = error[:, None] * p["last"] * (pooled > 0)
        rows = np.arange(len(x))
        for half, places in enumerate(best):
            flow = back[:, half * n : (half + 1) * n]
            out["shift"] += flow.sum(0)
            for f in range(n):
                taken = patches[rows, places[:, f]]
                out["filters"][:, f] += flow[:, f] @ taken
                shares = (flow[:, f, None] * p["filters"][:, f]).reshape(len(x), self.reach, -1)
                for k in range(self.reach):
                    np.add.at(out["embedding"], x[rows, places[:, f] + k], shares[:, k])
        return out

    def packed(self, moments: list[dict[str, np.ndarray]]) -> np.ndarray:
        return np.concatenate([v.ravel() for parts in (self.parts, *moments) for v in parts.values()])

    def unpacked(self, state: np.ndarray) -> list[dict[str, np.ndarray]]:
        """Takes the parameters from the state; the two moments of the descent behind them are returned."""
        sizes = [v.size for v in self.parts.values()]
        found = []
        for block in state.reshape(3, -1):
            cut = np.split(block, np.cumsum(sizes)[:-1])
            found.append({k: c.reshape(v.shape).copy() for (k, v), c in zip(self.parts.items(), cut)})
        self.parts = found[0]
        return found[1:]

    def walk(self, x: np.ndarray, y: np.ndarray, moments: list[dict[str, np.ndarray]], step: int, order: np.ndarray, batch: int = 128, rate: float = 0.005) -> int:
        """One pass over the rows in this order, a step a mini-batch; the number of the last step."""
        mean, square = moments
        for at in range(0, len(order), batch):
            step += 1
            for k, g in self.gradient(x[order[at : at + batch]], y[order[at : at + batch]]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                self.parts[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return step

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[i : i + 256])[0] for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)


def public_formats(n: int, seed: int = 3) -> list[tuple[str, int]]:
    """(run, is secret) in formats that vendors and standards publish, and everyday runs that look alike."""
    random = np.random.default_rng(seed)
    wide = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    low, base64 = "abcdefghijklmnopqrstuvwxyz0123456789", wide + "+/"

    def some(letters: str, least: int, most: int | None = None) -> str:
        return "".join(letters[i] for i in random.integers(0, len(letters), random.integers(least, (most or least) + 1)))

    def word() -> str:
        return some("aeiounrstlmdc", 3, 9)

    out = []
    for _ in range(n):
        out += [
            ("ghp_" + some(wide, 36), 1),
            ("sk_live_" + some(wide, 24, 40), 1),
            ("xoxb-" + some("0123456789", 11) + "-" + some(wide, 24), 1),
            ("AIza" + some(wide + "_-", 35), 1),
            ("eyJ" + some(base64, 20, 30) + "." + some(base64, 30, 60) + "." + some(wide + "-_", 30, 43), 1),
            (some(base64, 39, 43) + "=", 1),
            (some(wide, 24, 48), 1),
            (some(low, 28, 44), 1),
            ("-".join(word() for _ in range(3)) + f"-{random.integers(1, 99)}", 0),
            ("/".join(word() for _ in range(4)) + f"/{random.integers(1, 9999)}", 0),
            ("_".join(word() for _ in range(3)) + f"_v{random.integers(1, 9)}", 0),
            (f"{random.integers(1990, 2030)}-{random.integers(10, 13)}-{random.integers(10, 29)}-{word()}-{word()}", 0),
            (f"www.{word()}{random.integers(1, 9)}.example.org/{word()}", 0),
            (f"{word()}.{random.integers(1, 99)}-{word()}.example.com", 0),
            (f"{word().title()}{word().title()}{word().title()}{random.integers(1, 20)}", 0),
            (f"{word()}-{random.integers(1, 9)}.{random.integers(0, 20)}.{random.integers(0, 9)}-{word()}.tar", 0),
            (some("0123456789", 3) + "-" + some("0123456789", 3) + "-" + some("0123456789", 4) + "-ext" + some("0123456789", 3), 0),
            (word() + "=" + word() + some("0123456789", 1, 4) + "." + word() + "." + word(), 0),
        ]
    return [(run, y) for run, y in out if len(run) >= 16]


def findings_of(docs: DataFrame) -> DataFrame:
    """Distinct `before, run, after, label` of all documents with an id: what the patterns take is 1, plainly everyday runs are 0."""

    def found(batches):
        for batch in batches:
            for part in pieces_of(batch):
                out = []
                for text in part.column("text").to_pylist():
                    taken = base_spans(text or "")
                    named = ASSIGN.finditer(text) if any(k == "assign" for _, _, k in taken) else ()
                    runs = [(m.start(2), m.end(2), 1) for m in named if m.end(2) - m.start(2) >= 16]
                    runs += [(a, b, 1) for a, b, k in taken if k != "assign"] + [(a, b, 0) for a, b in candidates(text or "", taken) if everyday(text[a:b])]
                    out += [(text[max(a - SIDE, 0) : a], text[a:b][: 4 * RUN], text[b : b + SIDE], y) for a, b, y in runs]
                yield pa.RecordBatch.from_pydict(dict(zip(("before", "run", "after", "label"), map(list, zip(*out)))) if out else {c: [] for c in schema.names}, schema=schema)

    schema = pa.schema([("before", pa.string()), ("run", pa.string()), ("after", pa.string()), ("label", pa.int32())])
    return texts_of(docs).where("doc_id IS NOT NULL").select("text").mapInArrow(lean(found), FINDING).distinct()


def examples(findings: DataFrame, parts: int, seed: int) -> DataFrame:
    """`part, x, y, aside`, one row per part: classes of the windows, labels, and which rows are kept out of training, as bytes.

    Each finding comes once with its own context and twice with one dealt anew among those of its part; `aside` goes by the run alone.
    """

    def dealt(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        random = np.random.default_rng(seed + 10 * part)
        table = group.to_pandas().dropna(subset=["label"]).astype({"label": int}).sort_values(["label", "run", "before", "after"])
        own = list(zip(table["before"], table["run"], table["after"], table["label"]))
        around = [(b, a) for b, _, a, _ in own] or [("", "")]
        around += [("the value is ", " and "), ("", ""), ("see ", "."), ("\n", "\n"), ("= ", "\n"), ('"', '"'), ("(", ")")] * max(1, len(around) // 7)
        dealt = [(*around[random.integers(len(around))], r, y) for _ in range(2) for _, r, _, y in own]
        dealt += [(*around[random.integers(len(around))], r, y) for r, y in public_formats(FORMATS, seed=3 + 10 * part)]
        rows = own + [(b, r, a, y) for b, a, r, y in dealt]
        x = np.array([next(windows(b + r + a, len(b), len(b) + len(r))) for b, r, a, _ in rows], dtype=np.uint8)
        y = np.array([r[3] for r in rows], dtype=np.uint8)
        aside = np.array([int(hashlib.md5(r[1].encode()).hexdigest()[:6], 16) % 5 == 0 for r in rows], dtype=np.uint8)
        give_back()
        return pa.table({"part": pa.array([part], pa.int32()), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (("x", x), ("y", y), ("aside", aside))}})

    part = F.pmod(F.xxhash64("run", "before", "after", "label"), F.lit(parts)).cast("int").alias("part")
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in FINDING.split(", "))]
    every = findings.sparkSession.range(parts).select(F.col("id").cast("int").alias("part"), *none)  # a part without findings has its public formats
    rows = findings.select(part, "before", "run", "after", "label").unionByName(every).repartition(parts, "part")
    return rows.groupBy("part").applyInArrow(dealt, "part int, x binary, y binary, aside binary")


def rows_of(batches: Iterator[pa.RecordBatch], aside: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, x, y) of the rows set aside, or of the others."""
    for batch in batches:
        for part, *columns in zip(*(batch.column(c) for c in ("part", "x", "y", "aside"))):
            x, y, out = (np.frombuffer(c.as_buffer(), dtype=np.uint8) for c in columns)
            kept = (out > 0) == aside
            yield part.as_py(), x.reshape(-1, WIDTH)[kept], y[kept].astype(float)


def trained(parts: DataFrame, passes: int = 8, seed: int = 2) -> Network:
    """Each pass walks through all parts at once, from the average of the networks that the pass before left, weighted by rows."""

    def averaged(rows, states) -> np.ndarray:
        return sum(n / sum(rows) * np.frombuffer(s) for n, s in zip(rows, states))

    def joined_parts(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")  # sums in one order, whatever the tasks
        part, rows, steps, states = (group.column(c).to_pylist() for c in names)
        return pa.table({"part": pa.array(part[:1], pa.int32()), "rows": [sum(rows)], "step": [max(steps)], "state": pa.array([averaged(rows, states).tobytes()], pa.binary())})

    names, schema = ["part", "rows", "step", "state"], "part int, rows long, step long, state binary"
    network = Network()
    state, step = network.packed([{k: np.zeros_like(v) for k, v in network.parts.items()} for _ in range(2)]), 0
    for number in range(passes):

        def walked(batches, number=number, state=state, step=step):
            for part, x, y in rows_of(batches, aside=False):
                local, random = Network(), np.random.default_rng(seed + 10 * part)
                moments = local.unpacked(state)
                order = [random.permutation(len(x)) for _ in range(number + 1)][-1]
                last = local.walk(x, y, moments, step, order)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "rows": [len(x)], "step": [last], "state": pa.array([local.packed(moments).tobytes()], pa.binary())})

        states = parts.mapInArrow(lean(walked), schema)
        _, rows, steps, means = zip(*sorted(states.groupBy(F.floor(F.col("part") / JOINED)).applyInArrow(joined_parts, schema).collect()))
        state, step = averaged(rows, means), max(steps)
    network.unpacked(state)
    return network


def fit(docs: DataFrame, recall: float = 0.95, seed: int = 4) -> dict:
    """Network, calibration and threshold from the findings of all documents; a document without an id has no part in them.

    Contexts are dealt anew to two thirds of the findings, so that the words before a key do not decide alone. A fifth of the findings,
    kept out of training, calibrates the scores and sets the threshold. The first window of a run stands for it.
    """
    findings = findings_of(docs).persist(StorageLevel.MEMORY_AND_DISK)
    held = [findings]
    try:
        parts = max(1, -(-findings.count() // PART))
        rows = examples(findings, parts, seed).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(rows)
        network = trained(rows)

        def scored(batches):
            for _, x, y in rows_of(batches, aside=True):
                yield pa.RecordBatch.from_arrays([pa.array(network.scores(x)), pa.array(y.astype(np.int32))], ["raw", "label"])

        raw = rows.mapInArrow(lean(scored), "raw double, label int").persist(StorageLevel.MEMORY_AND_DISK)
        held.append(raw)
        knots = fit_isotonic_table(raw, "raw", "label", parts)

        def lowest(_g, n):  # the largest score that leaves out no more than the share that may be missed
            return [int((n - 1) * (1 - recall)) + 1]

        _, found = order_statistics(raw.where("label > 0"), F.col("raw"), lowest)
        lowest_raw = [v.value for ranks in found.values() for v in ranks.values()]
        threshold = float(calibrated(np.array(lowest_raw), knots)[0]) if lowest_raw else 1.0
        return {"network": network, "knots": knots, "threshold": threshold}
    finally:
        for table in held:
            table.unpersist()


def network_spans(texts: list[str], taken: list[list[tuple[int, int, str]]], model: dict) -> list[list[tuple[int, int, str]]]:
    """Candidates of each text that the network takes for secrets; a long run counts by its likeliest window."""
    where, x = [], []
    for i, text in enumerate(texts):
        for start, end in candidates(text, taken[i]):
            for window in windows(text, start, end):
                where.append((i, start, end))
                x.append(window)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if x:
        p = calibrated(model["network"].scores(np.array(x)), model["knots"])
        for i, start, end in sorted({w for w, v in zip(where, p) if v >= model["threshold"]}):
            out[i].append((start, end, KINDS[3]))
    return out


def spans_of(texts: list[str], model: dict) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text, by start and then kind."""
    base = [base_spans(t) for t in texts]
    for b, more in zip(base, network_spans(texts, base, model)):
        yield b, sorted(b + more, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_assign, n_access, n_hex, n_network, base_sha256, spans` for every row, from its whole text.

    A span is kind:start:end of a whole match, in code points, the end exclusive. A NULL or empty text has no spans: zero
    counts, an empty list and the digest of it. Rows are scanned one by one, so NULL or repeated ids get their rows;
    an empty table gives an empty one.
    """

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch):
                found = list(spans_of([t or "" for t in part.column("text").to_pylist()], model))
                counts = [pa.array([sum(s[2] == k for s in every) for _, every in found], pa.int64()) for k in KINDS]
                digests = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], pa.string())
                columns = [part.column("doc_id"), *counts, digests, pa.array([joined(e) for _, e in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_network long, base_sha256 string, spans string"
    return texts_of(docs, id_col, text_col).mapInArrow(run, schema)


def redact(docs: DataFrame, model: dict, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, every span in `text` replaced by `mark`; overlapping spans share one. NULL stays NULL."""

    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for some in text_slices(texts) if len(texts) else ():
                for text, (_, spans) in zip(some, spans_of([t or "" for t in some], model)):
                    parts, at = [], 0
                    for start, end, _ in spans:
                        if start >= at:
                            parts += [text[at:start], mark]
                        at = max(at, end)
                    out.append(text if not spans else "".join([*parts, text[at:]]))
            yield pd.Series(out, dtype=object)
        give_back()

    return docs.withColumn("text", F.pandas_udf(cleaned, "string")(F.col("text").cast("string")))
