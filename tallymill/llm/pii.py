"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The field labels whole segments of tokens. A segment of an entity may span up
to ``LONGEST`` tokens, one of no entity a single token; its score comes from
features of the whole span (shape, digits, separators, checksum) and of the
words around it. A dynamic program over ends, lengths and types chooses
boundaries and types together. Weights are learnt by maximum likelihood (the
expected features come from the forward and backward sums of the same program)
on windows labelled by the fixed patterns.

Windows lie around digits and at-signs; text without any cannot hold an entity
of the four types.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallymill.llm.common import map_batches, row_hash, slices, text_rows
from tallymill.llm.spans import Span, merged, regions
from tallymill.session import stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Begins only where a run of digits does and never gives digits back: linear in a long run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@](?:[^\s]*[0-9@])?")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_|\s+")

AROUND, LONGEST, MOST_TOKENS = 24, 16, 120
SAMPLE = 250  # distinct labelled windows with an entity, and as many without
PASSES, RATE, DECAY = 5, 0.3, 1e-3
CONFIDENCE = 0.9


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each at-sign backwards: linear in the text."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    return out


def fixed_spans(text: str) -> list[Span]:
    """The findings of the fixed patterns by kind, then start."""
    out: list[Span] = [("email", s, e) for s, e in emails(text)]
    if "." in text:
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        number = digits_of(m[0])
        if 13 <= len(number) <= 19 and luhn(number):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


class Window:
    """A stretch of text as tokens, with the features of its possible segments."""

    def __init__(self, text: str):
        self.text = text
        self.cuts = [0, *(m.end() for m in TOKEN.finditer(text))]
        self.n = len(self.cuts) - 1

    def piece(self, i: int, j: int) -> str:
        return self.text[self.cuts[i]:self.cuts[j]]

    def entity_features(self, i: int, j: int) -> list[str]:
        """Whole-span features of tokens i..j; empty where no entity can be."""
        span = self.piece(i, j)
        if not (span[0].isalnum() or span[0] in "+(") or not span[-1].isalnum():
            return []
        number = digits_of(span)
        if not number and "@" not in span:
            return []
        shape = re.sub("(.)\\1+", "\\1", re.sub("[^\\W\\d_]", "a", re.sub("[0-9]", "0", span)))
        before = self.piece(i - 1, i)[-1:] if i else ""
        after = self.piece(j, j + 1)[:1] if j < self.n else ""
        kind = lambda c: "0" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c
        out = ["bias", f"shape={shape}", f"digits={len(number)}", f"at={span.count('@')}",
               f"dots={span.count('.')}", f"gap={any(c.isspace() for c in span)}",
               f"letters={any(c.isalpha() for c in span)}", f"plus={span[0] == '+'}",
               f"before={kind(before)}", f"after={kind(after)}"]
        if 13 <= len(number) <= 19:
            out.append(f"luhn={luhn(number)}")
        if span.count(".") == 3:
            out.append(f"bytes={all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in span.split('.'))}")
        return out

    def outside_features(self, i: int) -> list[str]:
        token = self.piece(i, i + 1)
        kind = "0" if token[0].isdigit() else "a" if token[0].isalpha() else "_" if token.isspace() else token[0]
        return [f"kind={kind}", f"length={min(len(token), 8)}"]


class Field:
    """Weights by (type, feature), and the programs over segmentations."""

    def __init__(self) -> None:
        self.weights: dict[tuple[str, str], float] = {}

    def segments(self, window: Window) -> list[tuple[int, int, str, list[tuple[str, str]]]]:
        """Every allowed segment (start, end, type, features), by end."""
        out = []
        for j in range(1, window.n + 1):
            out.append((j - 1, j, "", [("", f) for f in window.outside_features(j - 1)]))
            for i in range(max(0, j - LONGEST), j):
                names = window.entity_features(i, j)
                out += [(i, j, kind, [(kind, f) for f in names]) for kind in KINDS if names]
        return out

    def scores(self, segments: Sequence) -> np.ndarray:
        get = self.weights.get
        return np.array([sum(get(f, 0.0) for f in s[3]) for s in segments])

    def sums(self, n: int, segments: Sequence, score: np.ndarray) -> np.ndarray:
        """The marginal probability of each segment, by sums from both sides."""
        starts, ends = (np.array([s[k] for s in segments], int) for k in (0, 1))
        into = np.searchsorted(ends, np.arange(n + 2))  # segments stand by their end
        ahead, behind = np.zeros(n + 1), np.full(n + 1, -np.inf)
        behind[n] = 0.0
        for j in range(1, n + 1):
            own = slice(into[j], into[j + 1])
            ahead[j] = np.logaddexp.reduce(ahead[starts[own]] + score[own])
        for j in range(n, 0, -1):
            own = slice(into[j], into[j + 1])
            np.logaddexp.at(behind, starts[own], score[own] + behind[j])
        return np.exp(ahead[starts] + score + behind[ends] - ahead[n])

    def best(self, window: Window) -> list[tuple[str, int, int, float]]:
        """The best segmentation's entities in characters, with their marginal probability."""
        if not window.n:
            return []
        segments = self.segments(window)
        score = self.scores(segments)
        value, back = np.full(window.n + 1, -np.inf), [0] * (window.n + 1)
        value[0] = 0.0
        for k, (i, j, _, _) in enumerate(segments):
            if value[i] + score[k] > value[j]:
                value[j], back[j] = value[i] + score[k], k
        chosen, at = [], window.n
        while at:
            chosen.append(back[at])
            at = segments[back[at]][0]
        if not any(segments[k][2] for k in chosen):
            return []
        sure = self.sums(window.n, segments, score)
        return [
            (segments[k][2], window.cuts[segments[k][0]], window.cuts[segments[k][1]], float(sure[k]))
            for k in reversed(chosen) if segments[k][2]
        ]

    def learn(self, examples: Sequence[tuple[str, Sequence[Span]]], seed: int = 0) -> None:
        """Stochastic ascent of the likelihood of the labelled segmentations."""
        prepared = []
        for text, spans in examples:
            window = Window(text)
            place = {c: i for i, c in enumerate(window.cuts)}
            gold = {(place.get(s), place.get(e), k) for k, s, e in spans}
            inside = {i for s, e, _ in gold if s is not None and e is not None for i in range(s, e)}
            segments = self.segments(window)
            truth = np.array([
                (i, j, k) in gold or (not k and i not in inside) for i, j, k, _ in segments
            ], float)
            covered = sum(j - i for (i, j, _, _), t in zip(segments, truth) if t)
            if window.n and covered == window.n and window.n <= MOST_TOKENS:
                prepared.append((window.n, segments, truth))
        order = np.random.default_rng(seed)
        for turn in range(PASSES):
            rate = RATE / (1 + turn)
            for k in order.permutation(len(prepared)):
                n, segments, truth = prepared[k]
                wrong = truth - self.sums(n, segments, self.scores(segments))
                for (_, _, _, names), by in zip(segments, wrong):
                    if abs(by) > 1e-3:
                        for f in names:
                            w = self.weights.get(f, 0.0)
                            self.weights[f] = w + rate * (by - DECAY * w)


def windows_of(text: str, fixed: Sequence[Span]) -> list[dict]:
    """The stretches around triggers, from the start of a word, with their fixed spans.

    Spans are in the window's own characters; of spans that overlap the one
    that begins first stands, for a segmentation has no overlaps.
    """
    out, low_free = [], 0
    ordered = sorted(((s, e, k) for k, s, e in fixed))
    for low, high in regions(text, TRIGGER, AROUND):
        low = max(low, low_free)
        while low > low_free and not text[low - 1].isspace() and high - low < 4 * AROUND:
            low -= 1
        inside, last = [], low
        for s, e, k in ordered:
            if s >= last and e <= high:
                inside.append({"kind": k, "low": s - low, "high": e - low})
                last = e
        out.append({"at": low, "seen": text[low:high], "known": inside})
        low_free = high
    return out


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One scan: fixed spans, and the windows that the field reads."""
    def work(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "fixed": [], "windows": []}
        for text in batch["text"]:
            fixed = fixed_spans(text) if TRIGGER.search(text) else []
            out["fixed"].append([{"kind": k, "low": s, "high": e} for k, s, e in fixed])
            out["windows"].append(windows_of(text, fixed))
        return out

    span = "array<struct<kind:string,low:long,high:long>>"
    return map_batches(
        text_rows(docs, id_col, text_col), work,
        f"doc_id long, fixed {span}, windows array<struct<at:long,seen:string,known:{span}>>",
    )


def train(table: DataFrame, size: int = SAMPLE) -> Field | None:
    """A field from at most ``size`` windows with and ``size`` without an entity, by smallest hash."""
    rows = table.select(F.inline("windows")).select("seen", "known").filter(F.length("seen") <= 8 * AROUND)
    examples: list[tuple[str, list[Span]]] = []
    for with_entity in (True, False):
        part = rows.filter((F.size("known") > 0) == with_entity).dropDuplicates(["seen"])
        examples += [
            (r["seen"], [(k["kind"], k["low"], k["high"]) for k in r["known"]])
            for r in part.orderBy(row_hash("seen"), "seen").limit(size).collect()
        ]
    if not any(spans for _, spans in examples):
        return None
    field = Field()
    field.learn(examples)
    return field


def span_finder(field: Field | None) -> Callable[[list[Span], list[dict]], list[Span]]:
    """From a text's fixed spans and windows to all its spans; windows met before are not read again."""
    rank = {k: i for i, k in enumerate(KINDS)}
    known: dict[str, list] = {}

    def entities(seen: str) -> list[tuple[str, int, int, float]]:
        whole = Window(seen)
        if whole.n <= MOST_TOKENS:
            return field.best(whole)
        out, step = [], MOST_TOKENS - LONGEST
        for first in range(0, whole.n, step):
            low, high = whole.cuts[first], whole.cuts[min(whole.n, first + MOST_TOKENS)]
            out += [(k, s + low, e + low, p) for k, s, e, p in field.best(Window(seen[low:high]))]
        return out

    def spans(base: list[Span], windows: list[dict]) -> list[Span]:
        more: list[Span] = []
        for w in windows if field else ():
            if w["seen"] not in known:
                known[w["seen"]] = entities(w["seen"])
            more += [(k, w["at"] + s, w["at"] + e) for k, s, e, p in known[w["seen"]] if p >= CONFIDENCE]
        return sorted(merged(base, more), key=lambda x: (rank[x[0]], x[1], x[2]))

    return spans


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fixed spans and all spans (kind, low, high), by kind, then start.

    Offsets are code points, ends exclusive. The field adds entities that it
    gives a probability of 0.9 or more and that touch no fixed span. NULL and
    empty texts have no spans. Rows are independent, so repeated rows repeat;
    other columns are not read; an empty table, or one without a
    single labelled window, gives fixed spans only. A window longer than 120 tokens is
    read in overlapping parts, so no text is left out.
    """
    table = stored(found(docs, id_col, text_col), "personal")
    field = train(table)
    def work(batch: dict[str, list]) -> dict:
        finder = span_finder(field)
        out: dict[str, list] = {"doc_id": batch["doc_id"], "fixed": batch["fixed"], "spans": []}
        for fixed, windows in zip(batch["fixed"], batch["windows"]):
            spans = finder([(f["kind"], f["low"], f["high"]) for f in fixed], windows)
            out["spans"].append([{"kind": k, "low": s, "high": e} for k, s, e in spans])
        return out

    span = "array<struct<kind:string,low:long,high:long>>"
    return map_batches(table, work, f"doc_id long, fixed {span}, spans {span}")


def masked(text: str, spans: Sequence[Span]) -> str:
    """``text`` with each span replaced by its kind; overlapping spans go as one, named by the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced; ``n_chars``, if there, follows the new text.

    Spans are found and replaced in the task that holds the text, so each row
    is masked by its own text: a row without an id too, rows that repeat an id
    each for itself. NULL texts stay NULL. Other columns pass as they are (of
    types that Arrow carries).
    """
    field = train(stored(found(docs, id_col, text_col).select("windows"), "personal"))
    place = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            finder = span_finder(field)
            for part in slices([batch]):
                texts = part.column(place).to_pylist()
                for i, text in enumerate(texts):
                    if text and TRIGGER.search(text):
                        fixed = fixed_spans(text)
                        texts[i] = masked(text, finder(fixed, windows_of(text, fixed)))
                kind = part.schema.field(place)
                yield part.set_column(place, kind, pa.array(texts, kind.type))

    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema])
    out = docs.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(f"`{text_col}`")).cast(docs.schema["n_chars"].dataType))
    return out
