"""Near copies by one-permutation MinHash, banded buckets and stars.

Signature: a set's shingle hashes, which are one random order already, are dealt
to ``BINS`` bins by their leading bits, and each bin keeps its smallest. An
empty bin takes the value of the first filled one in its own fixed sequence
of random bins (optimal densification), so two sets agree in a bin with the
probability of their Jaccard similarity, however small they are.

Buckets: four bins make a band; sets that agree in a whole band share a bucket.
Two sets at 0.8 share none of the 32 with a probability under one in ten million.

Stars: a bucket proposes only edges between its members and one centre, so a
bucket of k sets gives k - 1 pairs. Every edge is confirmed on the full sets,
and confirmed ones join components. Members that are not in their centre's
component then meet again in finer buckets (two bands together) with centres
drawn anew, each set with the few centres it shares most buckets with. What
members of one bucket are still in different components after ``ROUNDS`` rounds
is compared whole, but for pairs that a bitmap of the sets rules out: no link
between members of a bucket is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.bitmaps import BITS, bitmaps_of, may_link
from tallymill.llm.common import U64, map_batches, mixed, shingle_sets, text_rows
from tallymill.llm.components import contracted, labels_of
from tallymill.session import stored

SHINGLE_WORDS = 4
BIN_BITS = 7
BINS = 1 << BIN_BITS
BAND_BINS = 4
BANDS = BINS // BAND_BINS
ROUNDS = 3
EARLY_STARS = 2  # contractions between rounds; labels need not be final there
CENTRES = (2, 8)  # edges a set takes part in as a member: in the first round, and in later ones


def _donors(attempt: int) -> np.ndarray:
    """Which bin each bin asks at this attempt."""
    return (mixed(np.arange(BINS, dtype=U64) + U64(BINS * attempt + 1)) >> U64(64 - BIN_BITS)).astype(np.int64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BINS`` values per set; sets are sorted and not empty."""
    sizes = np.array([len(s) for s in sets])
    hashes = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    cell = row * BINS + (hashes >> U64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))  # sorted, so the smallest of its bin
    values = np.zeros(len(sets) * BINS, U64)
    filled = np.zeros(len(sets) * BINS, bool)
    values[cell[first]], filled[cell[first]] = hashes[first], True
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        donor = empty // BINS * BINS + _donors(attempt)[empty % BINS]
        found = filled[donor]
        values[empty[found]] = values[donor[found]]
        empty = empty[~found]
        attempt += 1
    return values.reshape(-1, BINS)


def band_keys(values: np.ndarray) -> np.ndarray:
    """A key for each band of each signature; bands never share a key but by chance."""
    keys = np.zeros((len(values), BANDS), U64) + np.arange(BANDS, dtype=U64) * U64(0x9E3779B97F4A7C15)
    for k in range(BAND_BINS):
        keys = mixed(keys + values[:, k::BAND_BINS])
    return keys.astype(np.int64)


def sketched(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``n``, a 128-bit digest of the set, and its band keys (none for an empty set)."""
    def work(batch: dict[str, list]) -> dict:
        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        some = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        if some:
            for i, keys in zip(some, band_keys(signatures([sets[i] for i in some]))):
                bands[i] = keys
        return {
            "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
            "d1": [int(s.sum(dtype=U64).astype(np.int64)) for s in sets],
            "d2": [int(mixed(s + U64(0x51ED270B)).sum(dtype=U64).astype(np.int64)) for s in sets],
            "bands": bands,
        }

    return map_batches(rows, work, "doc_id long, n long, d1 long, d2 long, bands array<long>", rows=1024)


def full_sets(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rep`` and the whole shingle set of each member."""
    def work(batch: dict[str, list]) -> dict:
        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        return {"rep": batch["doc_id"], "hashes": [s.astype(np.int64) for s in sets]}

    chosen = members.select(F.col("rep").alias("doc_id"))
    return map_batches(rows.join(chosen, "doc_id", "left_semi"), work, "rep long, hashes array<long>", rows=1024)


def star_edges(placed: DataFrame, seed: int) -> DataFrame:
    """(x, nx, y, ny, buckets): each member with its bucket's centre, if of another component.

    ``placed`` holds (key, rep, n, label). A bucket's centre and whether it has
    several labels come from one aggregation, so a bucket of any size is
    combined before the shuffle.
    """
    turn = F.struct(F.xxhash64(F.lit(seed), "rep").alias("turn"), "rep", "n", "label")
    centres = placed.groupBy("key").agg(
        F.min(turn).alias("c"), F.min("label").alias("low"), F.max("label").alias("high")
    ).filter("low <> high").select("key", F.col("c.rep").alias("y"), F.col("c.n").alias("ny"), F.col("c.label").alias("other"))
    fits = 5 * F.least("n", "ny") >= 4 * F.greatest("n", "ny")
    return placed.join(centres, "key").filter((F.col("label") != F.col("other")) & fits).groupBy(
        F.col("rep").alias("x"), F.col("n").alias("nx"), "y", "ny"
    ).agg(F.count(F.lit(1)).alias("buckets"))


def nearest_centres(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` centres that each member shares most buckets with."""
    best = Window.partitionBy("x").orderBy(F.desc("buckets"), "y")
    return edges.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most).select("x", "nx", "y", "ny")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets have a Jaccard similarity of 0.8 or more."""
    common = F.size(F.array_intersect("sx", "sy"))
    return pairs.join(sets.select(F.col("rep").alias("x"), F.col("hashes").alias("sx")), "x").join(
        sets.select(F.col("rep").alias("y"), F.col("hashes").alias("sy")), "y"
    ).withColumn("common", common).filter(
        100 * F.col("common") >= 80 * (F.col("nx") + F.col("ny") - F.col("common"))
    ).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _fine_keys(turn: int):
    """Each band's key together with that of the band ``turn`` places on."""
    pair = F.zip_with(
        "bands", F.concat(F.slice("bands", turn + 1, BANDS), F.slice("bands", 1, turn)),
        lambda a, b: F.xxhash64(a, b),
    )
    return F.explode(pair)


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("rep"))
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return named.withColumn("label", F.coalesce("label", "rep"))


def undecided(placed: DataFrame) -> DataFrame:
    """The entries of buckets with members of several components."""
    several = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return stored(placed.join(several.filter("low <> high").select("key"), "key", "left_semi"), "undecided")


def rest_of_buckets(placed: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Pairs in one bucket, of two components, that their bitmaps do not rule out.

    ``placed`` holds (key, rep, n, label, bands). A pair comes from one of the
    buckets that it shares, that of the smallest key, not from each of them; all
    of them are in ``placed``, as such a pair makes a bucket undecided.
    """
    left = placed.join(stored(bitmaps, "bitmaps"), "rep")
    right = left.select("key", *(F.col(c).alias(f"{c}_2") for c in ("rep", "n", "label", "bands", *BITS)))
    fits = 5 * F.least("n", "n_2") >= 4 * F.greatest("n", "n_2")
    once = F.array_min(F.array_intersect("bands", "bands_2")) == F.col("l.key")
    apart = (F.col("rep") < F.col("rep_2")) & (F.col("label") != F.col("label_2")) & fits & may_link() & once
    return left.alias("l").join(right.alias("r"), (F.col("l.key") == F.col("r.key")) & apart).select(
        F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("rep_2").alias("y"), F.col("n_2").alias("ny")
    )


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept`` of every document.

    Words are split at ASCII white space after A-Z became a-z. Fewer than four
    words make one shingle; NULL, empty and blank texts have none and link with
    nothing. Documents with equal sets are one member. Rows that repeat id and
    text are one document, ids are otherwise unique; a row without an id is
    unlinked, has a NULL component and is kept. Other columns are not read; an
    empty table gives no rows.
    """
    rows = text_rows(docs, id_col, text_col)
    sizes = stored(sketched(rows), "sketches")
    classes = stored(
        sizes.filter("doc_id IS NOT NULL AND n > 0").groupBy("d1", "d2", "n")
        .agg(F.min(F.struct("doc_id", "bands")).alias("s"))
        .select("d1", "d2", "n", F.col("s.doc_id").alias("rep"), F.col("s.bands").alias("bands")), "classes",
    )
    coarse = classes.select("rep", F.explode("bands").alias("key"))
    shared = coarse.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    met = stored(coarse.join(shared, "key", "left_semi").select("rep").distinct(), "met")
    members = stored(classes.select("rep", "n", "bands").join(met, "rep", "left_semi"), "members")
    sets = stored(full_sets(rows, members).dropDuplicates(["rep"]), "sets")
    tied = labels = None
    for turn in range(rounds):
        named = _labelled(members, labels)
        keys = F.explode("bands") if turn == 0 else _fine_keys(turn)
        placed = stored(named.select("rep", "n", "label", keys.alias("key")), "placed")
        pairs = nearest_centres(star_edges(placed, turn), CENTRES[min(turn, 1)])
        found = stored(confirmed(stored(pairs, "stars"), sets), "links")
        if not found.isEmpty():
            tied = contracted(found if tied is None else tied.unionByName(found), EARLY_STARS)
            labels = labels_of(tied)
    if tied is not None:
        tied = contracted(tied)
        labels = labels_of(tied)
    apart = undecided(_labelled(members, labels).select(
        "rep", "n", "label", "bands", F.explode("bands").alias("key")
    ))
    if not apart.isEmpty():
        found = stored(confirmed(stored(rest_of_buckets(apart, bitmaps_of(sets)), "rest"), sets), "links")
        if not found.isEmpty():
            labels = labels_of(contracted(found if tied is None else tied.unionByName(found)))
    if labels is None:
        labels = members.select(F.col("rep").alias("node"), F.col("rep").alias("label"))
    groups = classes.select("d1", "d2", "n", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", "n", F.coalesce("label", "rep").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return sizes.select("doc_id", "n", "d1", "d2").distinct().join(stored(groups, "groups"), ["d1", "d2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
