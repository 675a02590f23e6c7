"""Packing documents into sequences of a fixed length as a cutting-stock problem.

A document is cut into pieces of a whole sequence and a rest. Rests fall into
length classes; only the number of pieces per class, a few hundred numbers,
reaches the driver. There a linear program over patterns (which classes share
a sequence) is solved by column generation: a knapsack over the sequence prices
new patterns against the current duals. Whole parts of the solution are kept,
the few pieces left over are packed first-fit. The pieces are ranked by class
and length over the whole table, and a piece's rank tells its pattern, its
sequence and its neighbours.
"""

from __future__ import annotations

import zlib
import warnings
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.bpe import codec
from tallymill.llm.common import map_batches, text_rows
from tallymill.operators.ranges import row_numbers
from tallymill.session import stored

CAPACITY, STEP, END_ID = 2048, 16, 1
SLOTS = "class int, low long, high long, copies int, sequence long"


def cut_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Encode each whole text, end it with id 1, and cut it at multiples of ``capacity``."""
    def work(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        for doc, ids in zip(batch["doc_id"], codec(path).encode(batch["text"])):
            ids = np.append(ids, END_ID).astype("<u4")
            for start in range(0, len(ids), capacity):
                piece = ids[start:start + capacity]
                row = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                for column, value in zip(out.values(), row):
                    column.append(value)
        return out

    return map_batches(
        text_rows(docs, id_col, text_col), work,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", rows=1024,
    )


def best_pattern(price: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of ``size`` units; class c takes c + 1 of them."""
    value, choice = np.zeros(size + 1), np.zeros(size + 1, int)
    for room in range(1, size + 1):
        n = min(room, len(price))
        options = value[room - 1::-1][:n] + price[:n]
        k = int(np.argmax(options))
        value[room], choice[room] = (options[k], k + 1) if options[k] > value[room - 1] else (value[room - 1], 0)
    pattern, room = np.zeros(len(price), int), size
    while room:
        took = choice[room]
        if took:
            pattern[took - 1] += 1
        room -= max(1, took)
    return float(value[size]), pattern


def fractional_patterns(demand: np.ndarray, size: int, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each: the covering linear program, by column generation.

    The basis starts with one class per pattern. Surplus columns let a class be
    covered more often than it has pieces. Classes without pieces take no part.
    After ``rounds`` the patterns found so far are used, with a warning: they
    cover the demand as well, only their padding may be more than the least.
    """
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    need = demand[used].astype(float)
    nudged = need + need.sum() * 1e-9 * np.arange(1, len(used) + 1)  # no two ratios tie: no cycles
    basis = np.diag((size // (used + 1)).astype(float))
    cost = np.ones(len(used))
    inverse = np.diag(1 / basis.diagonal())  # kept up to date: sums, as small BLAS calls may start threads
    for _ in range(rounds):
        amount, dual = (inverse * nudged).sum(1), (inverse * cost[:, None]).sum(0)
        if dual.min() < -1e-9:
            column, price = np.zeros(len(used)), 0.0
            column[int(np.argmin(dual))] = -1.0
        else:
            prices = np.full(len(demand), -1.0)
            prices[used] = dual
            worth, pattern = best_pattern(prices, size)
            if worth <= 1 + 1e-7:
                break
            column, price = pattern[used].astype(float), 1.0
        change = (inverse * column).sum(1)
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.where(change > 1e-9, change, 1), np.inf)
        leaves = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaves]):
            break
        basis[:, leaves], cost[leaves] = column, price
        row = inverse[leaves] / change[leaves]
        inverse = inverse - np.outer(change, row)
        inverse[leaves] = row
    else:
        warnings.warn(f"column generation stopped after {rounds} rounds, before the optimum", stacklevel=2)
    amount = (inverse * need).sum(1)
    out = []
    for k in np.flatnonzero(cost):
        pattern = np.zeros(len(demand), int)
        pattern[used] = np.rint(basis[:, k]).astype(int)
        out.append((pattern, max(0.0, float(amount[k]))))
    return out


def whole_patterns(demand: np.ndarray, size: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole numbers of uses that cover the demand.

    What rounding down leaves over is less than one use per pattern, whatever
    the table's size, and is packed first-fit from long to short.
    """
    plan = [(p, int(x + 1e-6)) for p, x in fractional_patterns(demand, size)]
    plan = [(p, n) for p, n in plan if n]
    rest = demand - sum((p * n for p, n in plan), np.zeros(len(demand), int))
    open_: list[tuple[int, np.ndarray]] = []
    for c in range(len(demand) - 1, -1, -1):
        for _ in range(max(0, int(rest[c]))):
            at = next((i for i, (room, _) in enumerate(open_) if room > c), None)
            if at is None:
                open_.append((size, np.zeros(len(demand), int)))
                at = len(open_) - 1
            room, pattern = open_[at]
            pattern[c] += 1
            open_[at] = (room - c - 1, pattern)
    single = Counter(tuple(p) for _, p in open_)
    return plan + [(np.array(p), n) for p, n in single.items()]


def slot_table(demand: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
    """For ranks ``low`` < rank <= ``high`` of all pieces: class, copies per sequence, first sequence."""
    first = np.concatenate([[0], np.cumsum(demand)])
    filled, sequence, slots = first[:-1].copy(), 0, []
    for pattern, uses in whole_patterns(demand, size):
        for c in np.flatnonzero(pattern):
            low, high = int(filled[c]), int(min(first[c + 1], filled[c] + pattern[c] * uses))
            if high > low:
                slots.append((int(c) + 1, low, high, int(pattern[c]), sequence))
            filled[c] = high
        sequence += uses
    return slots


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, step: int = STEP,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    NULL and empty texts have one piece, the end id. Repeated rows are packed
    as often as they come; of pieces with one length, class and id any order is
    right. Sequence ids start at 0 and are unique, not dense. A text longer
    than a sequence is cut; no other column is read; an empty table gives no
    rows. Padding is less than ``step`` tokens per piece but for the last few
    sequences.
    """
    pieces = stored(
        cut_pieces(docs, path, id_col, text_col, capacity)
        .withColumn("class", F.ceil(F.col("length") / step).cast("int")), "pieces",
    )
    size = capacity // step
    demand = np.zeros(size, int)
    for row in pieces.groupBy("class").count().collect():
        demand[row["class"] - 1] = row["count"]
    slots = docs.sparkSession.createDataFrame(slot_table(demand, size), SLOTS)
    ranked = row_numbers(pieces, "rank", "class", "length", "doc_id", "start")
    within = (F.col("rank") > F.col("low")) & (F.col("rank") <= F.col("high"))
    placed = ranked.join(F.broadcast(slots), "class").filter(within).withColumn(
        "sequence_id", F.col("sequence") + F.floor((F.col("rank") - F.col("low") - 1) / F.col("copies"))
    )
    before = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
