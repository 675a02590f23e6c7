"""Periodic runs of words: stretches that repeat a shorter one at least twice.

At the scale of blocks of ``B`` words, a power of two, a run of a period from
``2 B - 1`` to ``4 B - 2`` holds an aligned block that comes again a period
later. So each block is laid over the window of words that follow it, and one
convolution gives the sum of squared differences for all distances at once, by
a number-theoretic transform in exact integers. Where the sum is zero the
block comes again; the distance is a seed, and the stretch around it is grown
word by word on both sides.

A block holding a word that does not come again within the scale's largest
distance has no such place and is left out before the transforms. The sums are
taken modulo a prime: a true zero is always zero, and a seed of which the
words differ is dropped when it is grown.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tallymill.llm.common import map_batches, text_rows

U64 = np.uint64
#: 15 * 2**27 + 1, so transforms of up to 2**27 places exist; 31 generates its units.
PRIME, GENERATOR = 2013265921, 31
LEAST_LENGTH = 12
CHUNK = 1 << 19
Run = tuple[int, int, int]


@lru_cache(maxsize=64)
def _roots(size: int, backward: bool) -> np.ndarray:
    """The powers of a root of unity of order ``size`` that one layer needs."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if backward:
        root = pow(root, -1, PRIME)
    powers = np.ones(max(1, size // 2), U64)
    have = 1
    while have < len(powers):
        step = U64(pow(root, have, PRIME))
        powers[have:2 * have] = powers[:have] * step % U64(PRIME)
        have *= 2
    return powers


def _forward(rows: np.ndarray) -> np.ndarray:
    """Transform each row; the result is in bit-reversed order."""
    count, size = rows.shape
    half = size // 2
    while half:
        parts = rows.reshape(count, -1, 2, half)
        a, b = parts[:, :, 0, :], parts[:, :, 1, :]
        total = (a + b) % U64(PRIME)
        parts[:, :, 1, :] = (a + U64(PRIME) - b) % U64(PRIME) * _roots(2 * half, False) % U64(PRIME)
        parts[:, :, 0, :] = total
        half //= 2
    return rows


def _backward(rows: np.ndarray) -> np.ndarray:
    """From bit-reversed transforms to the rows themselves."""
    count, size = rows.shape
    half = 1
    while half < size:
        parts = rows.reshape(count, -1, 2, half)
        a = parts[:, :, 0, :].copy()
        b = parts[:, :, 1, :] * _roots(2 * half, True) % U64(PRIME)
        parts[:, :, 0, :] = (a + b) % U64(PRIME)
        parts[:, :, 1, :] = (a + U64(PRIME) - b) % U64(PRIME)
        half *= 2
    return rows * U64(pow(size, -1, PRIME)) % U64(PRIME)


def _zero_differences(ids: np.ndarray, starts: np.ndarray, block: int, least: int, most: int) -> tuple:
    """(block start, distance) wherever the sum of squared differences is zero modulo the prime.

    ``ids`` ends in zeros, as many as the furthest window reaches past the words.
    """
    size, distances = 4 * block, most - least + 1
    squares = np.concatenate([[0], np.cumsum(ids.astype(U64) ** U64(2) % U64(PRIME))]).astype(U64)
    found = []
    for low in range(0, len(starts), max(1, CHUNK // size)):
        at = starts[low:low + max(1, CHUNK // size)]
        blocks, windows = np.zeros((len(at), size), U64), np.zeros((len(at), size), U64)
        blocks[:, :block] = ids[at[:, None] + np.arange(block - 1, -1, -1)]
        reach = distances + block - 1
        windows[:, :reach] = ids[at[:, None] + least + np.arange(reach)]
        product = _backward(_forward(blocks) * _forward(windows) % U64(PRIME))[:, block - 1:block - 1 + distances]
        over = at[:, None] + least + np.arange(distances)
        own = (squares[at + block] - squares[at])[:, None]
        theirs = squares[over + block] - squares[over]
        rest = (own + theirs) % U64(PRIME) + U64(2 * PRIME) - U64(2) * product
        row, distance = np.nonzero(rest % U64(PRIME) == 0)
        found.append((at[row], distance + least))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(map(np.concatenate, zip(*found)))


def _same_from(ids: np.ndarray, at: int, period: int, end: int) -> int:
    """How many places from ``at`` on equal the place a period later, before ``end``."""
    n, step = 0, 64
    while at + n + period < end:
        stop = min(at + n + step, end - period)
        other = np.flatnonzero(ids[at + n:stop] != ids[at + n + period:stop + period])
        if len(other):
            return n + int(other[0])
        n, step = stop - at, 2 * step
    return n


def _same_before(ids: np.ndarray, at: int, period: int, begin: int) -> int:
    """How many places right before ``at`` equal the place a period later, from ``begin`` on."""
    n, step = 0, 64
    while at - n > begin:
        low = max(begin, at - n - step)
        other = np.flatnonzero(ids[low:at - n] != ids[low + period:at - n + period])
        if len(other):
            return at - low - 1 - int(other[-1])
        n, step = at - low, 2 * step
    return n


def _gaps(ids: np.ndarray) -> np.ndarray:
    """How far on each word comes next; beyond the end where it does not."""
    order = np.argsort(ids, kind="stable")
    gaps = np.full(len(ids), len(ids) + 1, np.int64)
    again = ids[order[1:]] == ids[order[:-1]]
    gaps[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return gaps


def runs_of(ids: np.ndarray) -> list[Run]:
    """Every (start, length, period) of one text's word numbers (from 1), by start, then period.

    A run has its smallest period, at least ``max(12, 2 * period)`` words, and
    cannot be made longer on either side. The work grows as the number of
    words times the square of its logarithm, however many words repeat.
    """
    n = len(ids)
    if n < LEAST_LENGTH:
        return []
    gaps = _gaps(ids)
    found: dict[tuple[int, int], int] = {}  # (start, end) -> period
    block = 2
    while (least := 1 if block == 2 else 2 * block - 1) <= n // 2:
        most = 4 * block - 2
        starts = np.arange(0, n - block - least + 1, block)
        furthest = np.maximum.reduceat(gaps, np.arange(0, n, block))[:len(starts)]
        starts = starts[furthest <= most]
        if len(starts):
            padded = np.concatenate([ids, np.zeros(most + block, ids.dtype)])
            _grow(ids, found, block, *_zero_differences(padded, starts, block, least, most))
        block *= 2
    return sorted((a, b - a, q) for (a, b), q in found.items())


def _grow(ids: np.ndarray, found: dict[tuple[int, int], int], block: int, starts: np.ndarray, distances: np.ndarray) -> None:
    """Add the runs around the seeds of one scale to those of smaller periods.

    A seed inside a known run whose period divides its distance belongs to that
    run: with the longer period the stretch ends at the same places.
    """
    left = np.ones(len(starts), bool)  # seeds come ordered by start

    def settle(a: int, b: int, period: int) -> None:
        low, high = np.searchsorted(starts, [a, b])
        own = slice(low, high)
        inside = starts[own] + distances[own] + block <= b
        left[own] &= ~(inside & (distances[own] % period == 0))

    for (a, b), period in found.items():
        settle(a, b, period)
    for period in np.unique(distances[left]).tolist():
        for at in np.flatnonzero(distances == period).tolist():
            if not left[at]:
                continue
            s = int(starts[at])
            a = s - _same_before(ids, s, period, 0)
            b = s + _same_from(ids, s, period, len(ids)) + period
            settle(a, b, period)
            if b - a >= max(LEAST_LENGTH, 2 * period):
                found.setdefault((a, b), period)


def numbered(words: Sequence[bytes]) -> np.ndarray:
    """Each word's number, from 1 in order of first coming."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words))


def without_repeats(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words but those that some run holds after its first period."""
    if not runs:
        return list(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period) and ``collapsed`` text of every row.

    Words are split at ASCII white space; ``edit`` may change a document's
    words first. NULL, empty and blank texts have no words and no runs. Each
    row is worked on by itself, whole and where it is read: repeated rows
    repeat, a NULL id stays NULL, other columns are not read, and an empty
    table gives no rows.
    """
    def work(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n_words": [], "runs": [], "collapsed": []}
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            words = text.encode("utf-8").split()  # at the six ASCII white space bytes alone
            if edit:
                words = edit(doc_id, words)
            runs = runs_of(numbered(words))
            out["n_words"].append(len(words))
            out["runs"].append([dict(zip(("start", "length", "period"), r)) for r in runs])
            out["collapsed"].append(b" ".join(without_repeats(words, runs)).decode("utf-8"))
        return out

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_batches(text_rows(docs, id_col, text_col), work, schema)
