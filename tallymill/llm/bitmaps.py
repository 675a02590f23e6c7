"""Bitmaps of hash sets: an upper bound of two sets' overlap, for join conditions.

A bit of one set that the other lacks is an element that the other lacks, so
the bound never rules out a pair that links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import U64, map_batches, mixed

WORDS = 16  # of 64 bits
BITS = [f"bits{i}" for i in range(WORDS)]
OTHER = "_2"  # the suffix of the other side's columns


def bitmaps_of(sets: DataFrame) -> DataFrame:
    """``rep`` and a bit for each place that one of its hashes has among ``64 * WORDS``."""
    def work(batch: dict[str, list]) -> dict:
        bits = np.zeros((len(batch["rep"]), WORDS), U64)
        for row, hashes in zip(bits, batch["hashes"]):
            place = (mixed(hashes.astype(U64)) >> U64(32)) * U64(64 * WORDS) >> U64(32)
            np.bitwise_or.at(row, (place >> U64(6)).astype(np.int64), U64(1) << (place & U64(63)))
        return {"rep": batch["rep"], **{b: bits[:, i].astype(np.int64) for i, b in enumerate(BITS)}}

    return map_batches(sets, work, "rep long, " + ", ".join(f"{b} long" for b in BITS), arrays=["hashes"])


def may_link() -> Column:
    """Whether two sets of sizes ``n`` and ``n_2`` can have a Jaccard similarity of 0.8.

    They need 4/9 of both sizes in common, so neither may hold more than the
    rest that the other has not.
    """
    total = F.col("n") + F.col("n_2")

    def enough(ones: str, others: str) -> Column:
        alone = [F.bit_count(F.col(f"{b}{ones}").bitwiseAND(F.bitwise_not(F.col(f"{b}{others}")))) for b in BITS]
        return 9 * (F.col(f"n{ones}") - sum(alone[1:], alone[0])) >= 4 * total

    return enough("", OTHER) & enough(OTHER, "")
