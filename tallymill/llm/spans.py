"""Candidates for the two span finders: runs of text around digits and at-signs."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

Span = tuple[str, int, int]


def merged(base: list[Span], added: list[Span]) -> list[Span]:
    """``base`` and those of ``added`` that touch nothing before them."""
    taken, out = sorted((s, e) for _, s, e in base), list(base)
    for kind, start, end in sorted(added, key=lambda x: (x[1], x[2])):
        at = bisect.bisect_left(taken, (end, -1))
        if at and taken[at - 1][1] > start:
            continue
        bisect.insort(taken, (start, end))
        out.append((kind, start, end))
    return out


def text_of_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def regions(text: str, trigger: re.Pattern, around: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``text`` within ``around`` characters of a trigger, joined where they meet."""
    low = high = -1
    for found in trigger.finditer(text):
        start, end = max(0, found.start() - around), min(len(text), found.end() + around)
        if low < 0:
            low, high = start, end
        elif start <= high:
            high = end
        else:
            yield low, high
            low, high = start, end
    if low >= 0:
        yield low, high
