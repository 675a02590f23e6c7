"""Secrets: fixed patterns, and a character network over everything that looks like one.

A candidate is a run of at least 12 key-like characters, less what the fixed
patterns cover, with a digit, in mixed case, or of 20 characters or more. The
network reads the candidate with its surroundings as characters, a long one in
overlapping windows of which the highest score counts: an embedding, one convolution, the maximum over places, and a logistic output, all in numpy. It
is trained on all labelled findings, the candidates that the fixed patterns cover,
against all others; for part of them the surroundings are blanked, so that the
key itself must be told. The candidates are dealt into fifths by their text; each
fifth is judged by a network that was trained without it, as one that had learned
a candidate as "other" would only repeat that. All findings, so held out in
turn, calibrate the score and set the threshold that still finds 98 in 100 of
them. Candidates over the threshold are added to the fixed findings, whatever
the precision there: it is given beside them.

Training is work of the tasks: the windows are dealt into blocks, each block is
passed through in small steps from the same parameters, and their mean is where
all blocks begin their next pass.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import map_batches, slices, text_rows
from tallymill.llm.spans import Span, merged
from tallymill.operators.quantiles import value_counts
from tallymill.session import stored

KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")  # fixed values


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    f"(?:{'|'.join(map(_either_case, KEYWORDS))})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{12,}")
DIGIT, SMALL, CAPITAL = re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")
LEAST, LONG = 12, 20  # characters of a candidate; of one with neither a digit nor mixed case

BEFORE, INSIDE = 24, 48  # characters a window shows: before, and from its start on
STEP, AFTER = 12, 8  # from window to window; at least so many after the candidate are shown
SCORED = 4096  # windows scored at a time
BLOCK = 4096  # examples, about, that are passed through before networks are averaged
GRAIN = 1 << 20  # parts of one that are summed as whole numbers, the same in any order
RECALL, FOLDS = 0.98, 5
FILTERS, WIDTH, EMBEDDED, PASSES = 24, 5, 8, 30
LEAST_STEPS = 300  # of training, however few the examples
BATCH, RATE = 64, 0.003  # examples of a step, and its size


def fixed_spans(text: str) -> list[Span]:
    """The findings of the fixed patterns by start, then kind."""
    out: list[tuple[int, int, int]] = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(out)]


def key_like(run: str) -> bool:
    small, capital = SMALL.search(run), CAPITAL.search(run, 1)  # a first capital alone is a word
    if len(run) < LEAST:
        return False
    return bool(DIGIT.search(run) or small and capital or len(run) >= LONG and (small or CAPITAL.search(run)))


def candidates(text: str, fixed: list[Span]) -> list[tuple[int, int, bool]]:
    """Key-like runs, cut where a fixed span begins or ends, and whether one covers them."""
    spans, at, out = sorted((s, e) for _, s, e in fixed), 0, []
    for run in CANDIDATE.finditer(text):
        low, end = run.span()
        while at < len(spans) and spans[at][1] <= low:
            at += 1
        for start, stop in spans[at:] if at < len(spans) and spans[at][0] < end else ():
            if start >= end:
                break
            if start > low:
                out.append((low, start, False))
            if stop > low:
                out.append((max(low, start), min(stop, end), True))
                low = min(stop, end)
        out.append((low, end, False))
    return [c for c in out if key_like(text[c[0]:c[1]])]


def seen_of(text: str, start: int, end: int) -> str:
    """The characters before a candidate, itself, and what follows: as much as whole windows show."""
    steps = max(0, -(-(end - start + AFTER - INSIDE) // STEP))
    shown = INSIDE + steps * STEP
    return text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + text[start:start + shown].ljust(shown, "\0")


def windows_of(seen: str) -> list[str]:
    """From the first on; what is before a later one is part of the candidate, and not shown again."""
    size = BEFORE + INSIDE
    return [seen[:size], *("\0" * BEFORE + seen[i + BEFORE:i + size] for i in range(STEP, len(seen) - size + 1, STEP))]


def codes_of(windows: list[str]) -> np.ndarray:
    """ASCII as itself, anything else as 127."""
    raw = "".join(windows).encode("utf-32-le", "surrogatepass")
    return np.minimum(np.frombuffer(raw, np.uint32), 127).astype(np.int64).reshape(len(windows), -1)


@dataclass
class Network:
    """Character convolution with a logistic output."""

    table: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float

    @classmethod
    def drawn(cls, draw: np.random.Generator) -> Network:
        return cls(
            draw.normal(0, 0.3, (128, EMBEDDED)), draw.normal(0, 0.2, (WIDTH * EMBEDDED, FILTERS)),
            np.zeros(FILTERS), draw.normal(0, 0.2, FILTERS), 0.0,
        )

    @classmethod
    def of(cls, vector: np.ndarray) -> Network:
        shapes = (128, EMBEDDED), (WIDTH * EMBEDDED, FILTERS), (FILTERS,), (FILTERS,)
        parts = np.split(vector, np.cumsum([math.prod(s) for s in shapes]))
        return cls(*(part.reshape(s) for part, s in zip(parts, shapes)), float(parts[-1][0]))

    def vector(self) -> np.ndarray:
        return np.concatenate([np.ravel(x) for x in (self.table, self.kernel, self.bias, self.weight, self.offset)])

    def logits(self, codes: np.ndarray) -> np.ndarray:
        out = [self._forward(codes[i:i + 512])[-1] for i in range(0, len(codes), 512)]
        return np.concatenate(out) if out else np.empty(0)

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        seen = np.lib.stride_tricks.sliding_window_view(codes, WIDTH, 1)
        stacked = self.table[seen].reshape(*seen.shape[:2], -1)
        held = np.maximum(np.einsum("npd,df->npf", stacked, self.kernel, optimize=False) + self.bias, 0)
        where = held.argmax(1)
        pooled = np.take_along_axis(held, where[:, None], 1)[:, 0]
        return seen, stacked, where, pooled, (pooled * self.weight).sum(1) + self.offset

    def step(self, codes: np.ndarray, truth: np.ndarray, state: dict, rate: float) -> None:
        """One Adam step on the logistic loss."""
        seen, stacked, where, pooled, logit = self._forward(codes)
        error = (_logistic(logit) - truth) / len(truth)
        back = error[:, None] * self.weight * (pooled > 0)
        rows = np.arange(len(codes))[:, None]
        picked = stacked[rows, where]  # of each example and filter, what it looked at
        kernel = np.einsum("nf,nfd->df", back, picked)
        table = np.zeros_like(self.table)
        share = np.einsum("nf,df->nfd", back, self.kernel).reshape(*back.shape, WIDTH, EMBEDDED)
        np.add.at(table, seen[rows, where], share)
        slopes = {"table": table, "kernel": kernel, "bias": back.sum(0),
                  "weight": (error[:, None] * pooled).sum(0), "offset": error.sum()}
        state["t"] = t = state.get("t", 0) + 1
        for name, slope in slopes.items():
            m, v = state.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
            state[name] = m, v
            move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            setattr(self, name, getattr(self, name) - move)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fold_of(key: str) -> int:
    return zlib.crc32(key.encode("utf-8", "surrogatepass")) % FOLDS


def _blanked(codes: np.ndarray) -> np.ndarray:
    blank = codes.copy()
    blank[:, :BEFORE] = 0
    return blank


def _trained(
    net: Network, codes: np.ndarray, labels: np.ndarray, times: np.ndarray, passes: int, draw: np.random.Generator,
) -> Network:
    """``net`` after so many passes over the examples, each taken ``times`` over."""
    blank, used = _blanked(codes), np.repeat(np.arange(len(codes)), times)
    state: dict = {}
    for _ in range(passes):
        for part in np.array_split(draw.permutation(used), max(1, len(used) // BATCH)):
            hide = draw.random(len(part)) < 0.5
            net.step(np.where(hide[:, None], blank[part], codes[part]), labels[part], state, RATE)
    return net


@dataclass
class Networks:
    """A network for each fold, trained without it; ``threshold`` is on the calibrated score.

    ``precision`` is the share of findings among the held-out examples over the threshold.
    """

    nets: list[Network]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    precision: float = 0.0

    def logits(self, codes: np.ndarray, folds: np.ndarray) -> np.ndarray:
        out = np.empty(len(codes))
        for fold, net in enumerate(self.nets):
            out[folds == fold] = net.logits(codes[folds == fold])
        return out

    def scores(self, codes: np.ndarray, folds: np.ndarray) -> np.ndarray:
        return _logistic(self.scale * self.logits(codes, folds) + self.shift)

    def highest(self, seen: list[str], folds: list[int]) -> np.ndarray:
        """The highest score over each candidate's windows."""
        out = np.zeros(len(seen))
        every = ((i, w) for i, text in enumerate(seen) for w in windows_of(text))
        while part := list(itertools.islice(every, SCORED)):
            owner = np.array([i for i, _ in part])
            np.maximum.at(out, owner, self.scores(codes_of([w for _, w in part]), np.array(folds)[owner]))
        return out


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One scan: fixed spans, and every candidate with its surroundings and whether a fixed span has it."""
    def work(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "fixed": [], "open": []}
        for text in batch["text"]:
            fixed = fixed_spans(text)
            out["fixed"].append([{"kind": k, "low": s, "high": e} for k, s, e in fixed])
            out["open"].append([
                {"low": s, "high": e, "known": known, "fold": fold_of(text[s:e]), "seen": seen_of(text, s, e)}
                for s, e, known in candidates(text, fixed)
            ])
        return out

    return map_batches(
        text_rows(docs, id_col, text_col), work,
        "doc_id long, fixed array<struct<kind:string,low:long,high:long>>, "
        "open array<struct<low:long,high:long,known:boolean,fold:int,seen:string>>",
    )


def labelled(table: DataFrame) -> DataFrame:
    """Every distinct window of the candidates, whether a fixed span has it, and its fold; written once."""
    def work(batch: dict[str, list]) -> dict:
        cut = {
            (w, c["known"], c["fold"]): None for row in batch["open"] for c in row for w in windows_of(c["seen"])
        }
        return dict(zip(("seen", "known", "fold"), map(list, zip(*cut)))) or {"seen": [], "known": [], "fold": []}

    rows = map_batches(table.select("open"), work, "seen string, known boolean, fold int").distinct()
    return stored(rows.repartition(2 * table.sparkSession.sparkContext.defaultParallelism), "windows")


@dataclass
class Course:
    """What one fold's network learns from: ``whole`` labels are learned from its own fold too."""

    whole: tuple[bool, bool]
    copies: int
    blocks: int
    passes: int


def courses(windows: DataFrame) -> list[Course] | None:
    """A course for each fold, or None without a finding to learn or without any other candidate.

    Where one fold has all examples of a label, its network learns these too.
    Findings are taken as often as makes them as many as the others.
    """
    count = {(r["known"], r["fold"]): r["count"] for r in windows.groupBy("known", "fold").count().collect()}
    total = [sum(n for (known, _), n in count.items() if known == label) for label in (False, True)]
    if not all(total):
        return None
    out = []
    for k in range(FOLDS):
        outside = [total[label] - count.get((bool(label), k), 0) for label in (0, 1)]
        others, findings = (outside[label] or total[label] for label in (0, 1))
        copies = max(1, others // findings)
        used = others + findings * copies
        blocks = -(-used // BLOCK)
        steps = max(1, used // blocks // BATCH)
        out.append(Course((not outside[0], not outside[1]), copies, blocks, max(PASSES, -(-LEAST_STEPS // steps))))
    return out


def examples(windows: DataFrame, plan: list[Course]) -> DataFrame:
    """A row for each block of each network: its windows, and how often each is taken; written once.

    The copies of a finding go to one block after the other, so that each block
    has its share of both labels.
    """
    each = F.array(*(
        F.struct(
            F.lit(net).alias("net"), F.lit(c.whole[0]).alias("others"), F.lit(c.whole[1]).alias("findings"),
            F.lit(c.copies).alias("copies"), F.lit(c.blocks).alias("blocks"),
        ) for net, c in enumerate(plan)
    ))
    known = F.col("known")
    dealt = (
        windows.select("*", F.inline(each))
        .filter((F.col("fold") != F.col("net")) | F.when(known, F.col("findings")).otherwise(F.col("others")))
        .withColumn("copies", F.when(known, F.col("copies")).otherwise(1))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.least("copies", "blocks") - 1)))
        .select(
            "net", "seen", "known",
            F.expr("int((pmod(xxhash64(seen, known, fold), blocks) + turn) % blocks)").alias("block"),
            F.expr("int((copies - 1 - turn) div blocks + 1)").alias("times"),
        )
    )
    held = F.sort_array(F.collect_list(F.struct("seen", "known", "times")))
    rows = dealt.groupBy("net", "block").agg(held.alias("windows"))
    tasks = min(sum(c.blocks for c in plan), 4 * windows.sparkSession.sparkContext.defaultParallelism)
    return stored(rows.repartitionByRange(tasks, "net", "block"), "examples")


def averaged(blocks: DataFrame, nets: list[Network], passes: list[int], seeds: tuple[int, ...]) -> list[Network]:
    """Each network's mean over its blocks, by their examples, after ``passes`` over each from ``nets``.

    Sums are of whole numbers, so that they do not depend on how blocks lie in tasks.
    """
    begun = [net.vector() for net in nets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in slices(batches, 1):
            (row,) = batch.to_pylist()
            k, windows = row["net"], row["windows"]
            times = np.array([w["times"] for w in windows])
            net = _trained(
                Network.of(begun[k].copy()), codes_of([w["seen"] for w in windows]),
                np.array([w["known"] for w in windows], float), times, passes[k],
                np.random.default_rng([*seeds, k, row["block"]]),
            )
            parts = np.rint(np.append(net.vector(), 1.0) * times.sum() * GRAIN).astype(np.int64)
            total[k] = total[k] + parts if k in total else parts
        for k, parts in total.items():
            columns = [pa.array([k], pa.int32()), pa.array([parts], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["net", "parts"])

    parts = blocks.mapInArrow(run, "net int, parts array<long>")
    parts = parts.select("net", F.posexplode("parts").alias("place", "part"))
    sums = np.zeros((len(nets), len(begun[0]) + 1))
    for r in parts.groupBy("net", "place").agg(F.sum("part").alias("part")).collect():
        sums[r["net"], r["place"]] = r["part"]
    return [Network.of(row[:-1] / row[-1]) for row in sums]


def held_out(windows: DataFrame, nets: Networks) -> DataFrame:
    """Logits of all windows, their surroundings blanked, by the network trained without them; written once."""
    def work(batch: dict[str, list]) -> dict:
        logits = nets.logits(_blanked(codes_of(batch["seen"])), np.array(batch["fold"]))
        return {"logit": logits, "known": batch["known"]}

    return stored(map_batches(windows, work, "logit double, known boolean", rows=SCORED), "logits")


def calibrated(scores: DataFrame) -> tuple[float, float]:
    """Scale and shift of the logistic fit, pulled towards the plain score: Newton's method, steps cut where too long."""
    def at(points: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Loss, slopes and curvatures at each (scale, shift)."""
        def work(batch: dict[str, list]) -> dict:
            logit, known = (np.array(batch[c], float) for c in ("logit", "known"))
            out = []
            for k, (scale, shift) in enumerate(points):
                z = scale * logit + shift
                p = _logistic(z)
                error, bend, loss = p - known, p * (1 - p), np.logaddexp(0, z) - known * z
                of_each = np.ones(len(z)), loss, error * logit, error, bend * logit ** 2, bend * logit, bend
                out.append((k, *map(np.sum, of_each)))
            return dict(zip(("point", *names), map(list, zip(*out))))

        names = [f"s{i}" for i in range(7)]
        rows = map_batches(scores, work, "point int, " + ", ".join(f"{c} double" for c in names))
        out = []
        for r in sorted(rows.groupBy("point").agg(*(F.sum(c).alias(c) for c in names)).collect()):
            off = points[r[0]] - (1.0, 0.0)
            loss, *rest = (x / r[1] for x in r[2:])
            slope = np.array(rest[:2]) + 0.01 * off
            curve = np.array([rest[2:4], rest[3:5]]) + 0.01 * np.eye(2)
            out.append((loss + 0.005 * float(off @ off), slope, curve))
        return out

    point = np.array([1.0, 0.0])
    (best,) = at([point])
    while True:
        move = np.linalg.solve(best[2], best[1])
        tried = [point - move / 2 ** i for i in range(10)]
        seen = at(tried)
        k = min(range(len(tried)), key=lambda i: seen[i][0])
        if seen[k][0] >= best[0] - 1e-12:
            return float(point[0]), float(point[1])
        point, best = tried[k], seen[k]


def train(windows: DataFrame, seed: int = 0) -> Networks | None:
    """Calibrated networks from all windows, or None without a finding to learn or without any other candidate.

    The score is a logistic fit of the held-out logits with the surroundings
    blanked. The threshold keeps ``RECALL`` of the held-out findings; it lies
    half way (in logits) between the last finding to be kept and the next other
    example below it, so that nothing held out but the lost findings is between.
    One block to a network needs no averaging and is passed through in one round.
    """
    plan = courses(windows)
    if plan is None:
        return None
    blocks = examples(windows, plan)
    rounds = PASSES if any(c.blocks > 1 for c in plan) else 1
    nets = [Network.drawn(np.random.default_rng([seed, k])) for k in range(FOLDS)]
    for turn in range(rounds):
        nets = averaged(blocks, nets, [-(-c.passes // rounds) for c in plan], (seed, turn))
    out = Networks(nets)
    scores = held_out(windows, out)
    out.scale, out.shift = calibrated(scores)
    findings = scores.filter("known")
    place = math.floor((findings.count() - 1) * (1 - RECALL))
    last = value_counts(findings, ["logit"]).filter(f"first <= {place} and after > {place}").first()["value"]
    below = scores.filter(~F.col("known") & (F.col("logit") < last)).agg(F.max("logit")).first()[0]
    middle = last if below is None else (last + below) / 2
    passed = scores.filter(F.col("logit") >= middle).agg(F.count_if("known"), F.count(F.lit(1))).first()
    out.threshold = float(_logistic(np.array(out.scale * middle + out.shift)))
    out.precision = passed[0] / passed[1]
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fixed spans, all spans (kind, low, high), and the network's precision.

    ``precision`` is the same in every row: the share of findings among the
    held-out examples over the threshold, NULL without a network. Offsets are code points, ends exclusive. The network adds spans of kind
    ``learned`` where no fixed span is. NULL and empty texts have no spans.
    Rows are independent, so repeated rows repeat; other columns are not read;
    a table without any finding of the fixed patterns gives no learned spans.
    """
    table = stored(found(docs, id_col, text_col), "secrets")
    net = train(labelled(table))

    def work(batch: dict[str, list]) -> dict:
        every = [c for row in batch["open"] for c in row if not c["known"]]
        good = net.highest([c["seen"] for c in every], [c["fold"] for c in every]) >= net.threshold if net else []
        passed = iter(good)
        out: dict[str, list] = {"doc_id": batch["doc_id"], "fixed": batch["fixed"], "spans": []}
        out["precision"] = [net.precision if net else None] * len(batch["doc_id"])
        for fixed, row in zip(batch["fixed"], batch["open"]):
            base = [(f["kind"], f["low"], f["high"]) for f in fixed]
            more = [("learned", c["low"], c["high"]) for c in row if not c["known"] and next(passed, False)]
            place = {k: i for i, k in enumerate((*KINDS, "learned"))}
            spans = sorted(merged(base, more), key=lambda x: (x[1], place[x[0]], x[2]))
            out["spans"].append([{"kind": k, "low": s, "high": e} for k, s, e in spans])
        return out

    span = "array<struct<kind:string,low:long,high:long>>"
    return map_batches(table, work, f"doc_id long, fixed {span}, spans {span}, precision double")
