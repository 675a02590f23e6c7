"""Documents whose five-word shingle sets are alike, joined by vertical partitioning.

The hash of a shingle is its place in one global order. The order is cut into
ranges; every set is cut at the same places, the overlap of two sets is
counted in each range by itself, and the counts are summed per pair.

Which pairs are counted:

1. Documents with equal sets are one class; from here on a class is one set.
2. Two sets with a Jaccard similarity of 0.8 share at least ``l`` of the first
   ``n - ceil(0.8 n) + l`` shingles of each in any common order. With ``l`` a
   fifth of the set, a set needs partners for two fifths of this prefix at
   least; most documents end here. Which prefix shingles have a partner is
   found per range of (scrambled) hashes, with copies combined before the
   shuffle: a shingle that all documents share is one entry per batch.
3. The shingles of what is left are ordered from rare to frequent, with exact
   frequencies. A pair must share one of the first ``n - ceil(0.8 n) + 1`` and,
   by its place there, enough can still follow.
4. Only the components matter. So each set first meets a few promising partners
   a round, for as long as rounds find links (``MOST_ROUNDS`` at most). Then
   every remaining pair of candidates that are not yet in one component is
   looked at, unless a bound says that it cannot link: each set has a bitmap of
   its shingles, and a bit of one set that the other lacks is a shingle that the
   other lacks. That step has no cap, so no link between components is lost.
5. A pair's overlap is counted fragment by fragment: one row for each pair and
   fragment that both sets have, and the counts summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.bitmaps import BITS, bitmaps_of, may_link
from tallymill.llm.common import U64, free_name, map_batches, mixed, shingle_sets, text_rows
from tallymill.llm.components import contracted, labels_of
from tallymill.session import stored

SHINGLE_WORDS = 5
RANGES = 8
PARTNERS = (2, 16)  # in the first round, and in later ones
MOST_ROUNDS = 2
EARLY_STARS = 2  # contractions between partner rounds; labels need not be final there
POSTING = 256
BUCKET_SHINGLES = 1 << 19


def least_common(n: np.ndarray | int) -> np.ndarray | int:
    """The smallest overlap that a set of ``n`` needs: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def spare(n: np.ndarray | int) -> np.ndarray | int:
    """How many shared shingles the long prefix of a set of ``n`` must hold."""
    return np.maximum(1, n // 5)


def _bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _scrambled(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(values.astype(U64)) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _dealt(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, the columns' values of that bucket, packed), for each bucket with any."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    starts = _runs(ordered)
    for low, high in zip(starts[:-1], starts[1:]):
        yield int(ordered[low]), *(_bytes(c[order[low:high]]) for c in columns)


def _unpacked(table: pa.Table, *names: str) -> list[np.ndarray]:
    kinds = {"hashes": U64, "again": np.bool_}
    return [np.frombuffer(b"".join(table.column(n).to_pylist()), kinds.get(n, np.int64)) for n in names]


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    if not len(ordered):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])


def buckets_for(sizes: DataFrame) -> int:
    """So many that a bucket holds about ``BUCKET_SHINGLES`` shingles, whatever the number of tasks.

    What passes between the tasks is packed by bucket, so more buckets than the
    data need would only make more and smaller rows.
    """
    return 1 + (sizes.agg(F.sum("n")).first()[0] or 0) // BUCKET_SHINGLES


def set_sizes(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``n`` and a 128-bit digest of the shingle set."""
    def work(batch: dict[str, list]) -> dict:
        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        return {
            "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
            "d1": [int(s.sum(dtype=U64).astype(np.int64)) for s in sets],
            "d2": [int(mixed(s + U64(0x51ED270B)).sum(dtype=U64).astype(np.int64)) for s in sets],
        }

    return map_batches(rows, work, "doc_id long, n long, d1 long, d2 long", rows=1024)


def promising(rows: DataFrame, buckets: int) -> DataFrame:
    """``doc_id`` and how many shingles of its long prefix some other document's holds too.

    Counted per bucket of hashes, then summed per bucket of documents; packed
    either way, so a document is not a row in every bucket that it meets.
    """
    def deal(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"kind": [], "bucket": [], "hashes": [], "owners": [], "again": []}

        def add(kind: int, bucket: int, hashes: bytes, owners: bytes, again: bytes) -> None:
            for column, value in zip(out.values(), (kind, bucket, hashes, owners, again)):
                column.append(value)

        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        size = np.array([len(s) for s in sets])
        take = np.where(size > 0, size - least_common(size) + spare(size), 0)
        hashes = np.concatenate([s[:k] for s, k in zip(sets, take)])
        owners = np.repeat(np.array(batch["doc_id"], np.int64), take)
        order = np.argsort(hashes, kind="stable")
        hashes, owners = hashes[order], owners[order]
        starts = _runs(hashes)
        length = np.diff(starts)
        first, shared = starts[:-1], np.repeat(length, length) > 1
        docs, counts = np.unique(owners[shared], return_counts=True)
        if len(docs):
            add(1, int(docs[0]) % buckets, _bytes(counts.astype(U64)), _bytes(docs), b"")
        again = length > 1  # counted here already, for all their owners
        for part in _dealt(_scrambled(hashes[first], buckets), hashes[first], owners[first], again):
            add(0, *part)
        return out

    def count(table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist())
        done, own = _unpacked(table.filter(pa.array(kinds == 1)), "hashes", "owners")
        hashes, owners, again = _unpacked(table.filter(pa.array(kinds == 0)), "hashes", "owners", "again")
        order = np.argsort(hashes, kind="stable")
        owners, again = owners[order], again[order]
        length = np.diff(_runs(hashes[order]))
        docs, counts = np.unique(
            owners[(np.repeat(length, length) > 1) & ~again], return_counts=True
        )
        owners, counts = np.concatenate([own, docs]), np.concatenate([done.astype(np.int64), counts])
        parts = list(_dealt(_scrambled(owners, buckets), owners, counts))
        return pa.table(list(map(list, zip(*parts))) or [[]] * 3, schema=by_doc)

    def total(table: pa.Table) -> pa.Table:
        owners, counts = _unpacked(table, "owners", "counts")
        docs, place = np.unique(owners, return_inverse=True)
        shared = np.zeros(len(docs), np.int64)
        np.add.at(shared, place, counts)
        return pa.table({"doc_id": docs, "shared": shared})

    by_doc = pa.schema([("bucket", pa.int32()), ("owners", pa.binary()), ("counts", pa.binary())])
    dealt = map_batches(rows, deal, "kind int, bucket int, hashes binary, owners binary, again binary")
    counted = dealt.groupBy("bucket").applyInArrow(count, "bucket int, owners binary, counts binary")
    return counted.groupBy("bucket").applyInArrow(total, "doc_id long, shared long")


def sets_of(rows: DataFrame) -> DataFrame:
    """``rep``, ``n`` and the set itself, in order, as signed numbers."""
    def work(batch: dict[str, list]) -> dict:
        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        return {"rep": batch["doc_id"], "n": [len(s) for s in sets], "hashes": [s.astype(np.int64) for s in sets]}

    return map_batches(rows, work, "rep long, n long, hashes array<long>", rows=1024)


def prefixes(sets: DataFrame, buckets: int) -> DataFrame:
    """The rare end of each set that can have a partner: (h, df, rep, n, pos).

    Shingles are counted per bucket of hashes, then dealt again by set; either
    way packed, so that the rows between the tasks do not grow with both the
    sets and the buckets. Shingles of one set alone go no further.
    """
    def deal(batch: dict[str, list]) -> dict:
        owners = np.repeat(np.array(batch["rep"], np.int64), batch["n"])
        sizes = np.repeat(np.array(batch["n"], np.int64), batch["n"])
        hashes = np.concatenate(batch["hashes"]).astype(U64)
        parts = list(_dealt(_scrambled(hashes, buckets), hashes, owners, sizes))
        return dict(zip(("bucket", "hashes", "owners", "sizes"), map(list, zip(*parts))))

    def count(table: pa.Table) -> pa.Table:
        hashes, owners, sizes = _unpacked(table, "hashes", "owners", "sizes")
        order = np.argsort(hashes, kind="stable")
        length = np.diff(_runs(hashes[order]))
        df = np.repeat(length, length)
        order, df = order[df > 1], df[df > 1]
        parts = list(_dealt(_scrambled(owners[order], buckets), hashes[order], owners[order], sizes[order], df))
        return pa.table(list(map(list, zip(*parts))) or [[]] * 5, schema=by_set)

    def cut(table: pa.Table) -> pa.Table:
        hashes, owners, sizes, df = _unpacked(table, "hashes", "owners", "sizes", "counts")
        order = np.lexsort((hashes, df, owners))
        hashes, owners, sizes, df = hashes[order], owners[order], sizes[order], df[order]
        starts = _runs(owners)
        shared = np.repeat(np.diff(starts), np.diff(starts))
        place = np.arange(len(owners)) - np.repeat(starts[:-1], np.diff(starts)) + sizes - shared
        rare = (shared >= least_common(sizes)) & (place < sizes - least_common(sizes) + 1)
        return pa.table({
            "h": hashes[rare].astype(np.int64), "df": df[rare], "rep": owners[rare],
            "n": sizes[rare], "pos": place[rare],
        })

    packed = "hashes binary, owners binary, sizes binary"
    by_set = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("hashes", "owners", "sizes", "counts"))])
    dealt = map_batches(sets.filter("n > 0"), deal, f"bucket int, {packed}", arrays=["hashes"])
    counted = dealt.groupBy("bucket").applyInArrow(count, f"bucket int, {packed}, counts binary")
    return counted.groupBy("bucket").applyInArrow(cut, "h long, df long, rep long, n long, pos long")


def _sizes_fit(a: Column, b: Column) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _labelled(prefix: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return prefix.withColumn("label", F.col("rep"))
    named = labels.withColumnRenamed("node", "rep")
    return prefix.join(named, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def few_partners(entries: DataFrame, seed: int, most: int) -> DataFrame:
    """Pairs (x, y) of different components, at most ``most`` per x: who stands next to x most often.

    The sets of a rare shingle stand in a random order, long lists in parts.
    """
    part = F.pmod(F.xxhash64("rep", F.lit(seed)), F.ceil(F.col("df") / POSTING))
    beside = Window.partitionBy("h", "part").orderBy(F.xxhash64("h", "rep", F.lit(seed)), "rep")
    met = (
        entries.withColumn("part", part)
        .withColumn("next", F.lead(F.struct("rep", "n", "label")).over(beside))
        .filter((F.col("next.label") != F.col("label")) & _sizes_fit(F.col("n"), F.col("next.n")))
        .select(F.col("rep").alias("x"), F.col("n").alias("nx"),
                F.col("next.rep").alias("y"), F.col("next.n").alias("ny"))
    )
    often = met.groupBy("x", "nx", "y", "ny").agg(F.count(F.lit(1)).alias("times"))
    best = Window.partitionBy("x").orderBy(F.desc("times"), "y")
    chosen = often.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most)
    return chosen.select("x", "nx", "y", "ny")


def undecided(labelled: DataFrame) -> DataFrame:
    """The entries of shingles whose owners are in several components."""
    mixed_lists = labelled.groupBy("h").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter(
        "_low <> _high"
    ).select(F.col("h").alias("_h"))
    return labelled.join(mixed_lists, F.col("h") == F.col("_h"), "left_semi")


def all_partners(entries: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every pair of candidates in different components that the bitmaps do not rule out.
    """
    left = entries.select("h", "rep", "n", "pos", "label").join(bitmaps, "rep")
    right = left.select("h", *(F.col(c).alias(f"{c}_2") for c in ("rep", "n", "pos", "label", *BITS)))
    total = F.col("n") + F.col("n_2")
    enough = 9 * F.least(F.col("n") - F.col("pos"), F.col("n_2") - F.col("pos_2")) >= 4 * total
    match = (F.col("rep") < F.col("rep_2")) & (F.col("label") != F.col("label_2")) & enough
    possible = match & _sizes_fit(F.col("n"), F.col("n_2")) & may_link()
    pairs = left.alias("l").join(right.alias("r"), (F.col("l.h") == F.col("r.h")) & possible)
    return pairs.select(
        F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("rep_2").alias("y"), F.col("n_2").alias("ny")
    ).distinct()


def linked(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The pairs (a, b) of at least 0.8: overlaps counted by fragment, then summed per pair."""
    mine = pieces.select(F.col("rep").alias("x"), "fragment", F.col("hashes").alias("hx"))
    theirs = pieces.select(F.col("rep").alias("y"), "fragment", F.col("hashes").alias("hy"))
    partial = pairs.join(mine, "x").join(theirs, ["y", "fragment"]).select(
        "x", "y", "nx", "ny", F.size(F.array_intersect("hx", "hy")).alias("part")
    )
    summed = partial.groupBy("x", "y", "nx", "ny").agg(F.sum("part").alias("common"))
    alike = 100 * F.col("common") >= 80 * (F.col("nx") + F.col("ny") - F.col("common"))
    return summed.filter(alike).select(F.col("x").alias("a"), F.col("y").alias("b"))


def fragments(sets: DataFrame, ranges: int = RANGES) -> DataFrame:
    """(rep, fragment, hashes): every set cut at the same places of the global order."""
    step = (1 << 64) // ranges
    edges = np.array([i * step for i in range(1, ranges)], U64)

    def work(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"rep": [], "fragment": [], "hashes": []}
        for rep, h in zip(batch["rep"], batch["hashes"]):
            for i, part in enumerate(np.split(h, np.searchsorted(h.astype(U64), edges))):
                if len(part):
                    for column, value in zip(out.values(), (rep, i, part)):
                        column.append(value)
        return out

    return map_batches(sets, work, "rep long, fragment int, hashes array<long>", arrays=["hashes"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable by links) of every document.

    Words are split at ASCII white space after A-Z became a-z. Fewer than five
    words make one shingle; NULL, empty and blank texts have none and link with
    nothing. Rows that repeat id and text are one document, ids are otherwise
    unique, and rows without an id come back unlinked with a NULL component.
    No other column is read; an empty table gives no rows.
    """
    rows = text_rows(docs, id_col, text_col)
    sizes = stored(set_sizes(rows).distinct(), "set-sizes")
    named = rows.filter("doc_id IS NOT NULL")
    classes = stored(
        sizes.filter("doc_id IS NOT NULL AND n > 0").groupBy("d1", "d2", "n")
        .agg(F.min("doc_id").alias("rep")), "classes",
    )
    least_shared = F.greatest(F.lit(1), F.floor(F.floor((4 * F.col("n") + 4) / 5) / 5))
    left = stored(
        promising(named, buckets_for(sizes)).join(classes.withColumnRenamed("rep", "doc_id"), "doc_id")
        .filter(F.col("shared") >= least_shared).select(F.col("doc_id").alias("_id")), "promising",
    )
    chosen = named.join(left.hint("shuffle_hash"), F.col("doc_id") == F.col("_id"), "left_semi")
    sets = stored(sets_of(chosen).dropDuplicates(["rep"]), "sets")
    prefix = stored(prefixes(sets, buckets_for(sets)), "prefixes")
    kept = prefix.select(F.col("rep").alias("_rep")).distinct()
    kept_sets = sets.join(kept, F.col("rep") == F.col("_rep"), "left_semi")
    pieces = stored(fragments(kept_sets), "pieces")
    stars = labels = None

    def grown(pairs: DataFrame, rounds: int | None = None) -> bool:
        """Whether the pairs held links; if so, the stars and labels follow them."""
        nonlocal stars, labels
        found = stored(linked(pairs, pieces), "links")
        if found.isEmpty():
            return False
        stars = contracted(found if stars is None else stars.unionByName(found), rounds)
        labels = labels_of(stars)
        return True

    for seed in range(MOST_ROUNDS):
        entries = stored(undecided(_labelled(prefix, labels)), "undecided")
        if not grown(few_partners(entries, seed, PARTNERS[min(seed, 1)]), EARLY_STARS):
            break
    if stars is not None:
        stars = contracted(stars)
        labels = labels_of(stars)
    entries = undecided(_labelled(prefix, labels))
    if not entries.isEmpty():
        grown(all_partners(stored(entries, "undecided"), stored(bitmaps_of(kept_sets), "bitmaps")))
    if labels is None:
        labels = sets.select(F.col("rep").alias("node"), F.col("rep").alias("label"))
    groups = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", "n", F.coalesce("label", "rep").alias("component_id")
    )
    return sizes.join(stored(groups, "groups"), ["d1", "d2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each group of near copies; all columns."""
    key = free_name(docs, "_drop_id")
    dropped = near_groups(docs, id_col, text_col).filter("component_id <> doc_id").select(
        F.col("doc_id").alias(key)
    )
    match = F.col(f"`{id_col}`") == F.col(key)
    return docs.join(dropped.hint("shuffle_hash"), match, "left_anti")
