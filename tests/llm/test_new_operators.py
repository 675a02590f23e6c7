"""Repeats, spelling variants and MinHash against plain versions of their contracts, and at their edges."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tallymill.llm import minhash, repeats, spelling
from tallymill.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n long, word string, runs string, label string, key string"
WORDS = re.compile("[^\\x20\\x09-\\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, empty and long texts, repeated rows, an id of no row, and clashing column names."""
    long = " ".join(f"word{i % 997}x{i % 4001}" for i in range(40_000))
    kinds = [None, "", " \n\t", long, long + " end", "one two", "one two", "ab " * 9_000, "x" * 5_000 + " " + "y" * 5_000]
    rows = [(i - 2, t, 0, "w", "r", "l", "k") for i, t in enumerate(kinds)]
    return spark.createDataFrame([*rows, rows[5], (None, "one two", 0, "w", "r", "l", "k")], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_runs(x: list) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def test_runs_equal_plain_search():
    draw = random.Random(11)
    for _ in range(800):
        n, kinds = draw.randrange(0, 150), draw.choice([1, 2, 3, 6, 60])
        x = [draw.randrange(kinds) for _ in range(n)]
        for _ in range(draw.randrange(3) if n else 0):
            a, p = draw.randrange(n), draw.randrange(1, max(2, n // 3))
            for i in range(a, draw.randrange(a, n + 1)):
                x[i] = x[a + (i - a) % p]
        assert repeats.runs_of(repeats.numbered([b"%d" % w for w in x])) == plain_runs(x)


def test_long_periods_and_one_word():
    period = [b"%d" % i for i in range(5_000)]
    assert repeats.runs_of(repeats.numbered([b"z", *period * 3, b"y"])) == [(1, 15_000, 5_000)]
    assert repeats.runs_of(repeats.numbered([b"a"] * 50_000)) == [(0, 50_000, 1)]


def test_periodic_query_equals_plain_version(spark, folder, texts):
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert rows.keys() == texts.keys()
    some = 0
    for doc_id, text in texts.items():
        words = WORDS.findall(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, r = plain_runs(words) if n < 1500 else None, rows[doc_id]
        if runs is None:
            continue
        some += bool(runs)
        dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, milli)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert some > 10


def test_repeats_at_the_edges(edges, none):
    rows = repeats.repeated_runs(edges).collect()
    assert Counter(r.doc_id for r in rows) == Counter([*range(-2, 7), 3, None])
    by_id = {r.doc_id: r for r in rows}
    assert all(not by_id[i].runs and by_id[i].collapsed == "" for i in (-2, -1, 0))
    assert [tuple(x) for x in by_id[5].runs] == [(0, 9_000, 1)] and by_id[5].collapsed == "ab"
    assert by_id[3].collapsed == "one two"
    assert repeats.repeated_runs(none).isEmpty()


def plain_variants(counts: dict[str, int]) -> dict[str, tuple]:
    holes = defaultdict(set)
    near: dict[str, set[str]] = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].add(w)
            if (less := w[:k] + w[k + 1:]) in counts:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), counts.get(forms[w]))
    return out


def plain_counts(texts: dict[int, str]) -> dict[str, int]:
    total: Counter[str] = Counter()
    for doc_id, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            word = lower(run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def test_variant_query_equals_plain_version(spark, folder, texts):
    expected = plain_variants(plain_counts(texts))
    rows = QUERIES["op12_spelling_variants"](spark, folder).collect()
    assert len(rows) == len(expected)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == expected
    assert any(r.form and r.root != r.form for r in rows)


@pytest.mark.parametrize("levels, entries", [(1, 10), (5, 1 << 15), (16, 100)])
def test_variants_do_not_depend_on_the_key(spark, levels, entries):
    draw = random.Random(levels)
    words = {"".join(draw.choices("abéqrs", k=draw.randrange(5, 8))) for _ in range(400)}
    words |= {"b" * 40, "b" * 41, "b" * 32, "b" * 33, "b" * 20 + "c" + "b" * 20, "ab" * 40, "ab" * 40 + "c"}
    counts = {w: draw.randrange(3, 40) for w in words}
    docs = spark.createDataFrame([(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())], "doc_id long, text string")
    rows = spelling.variant_groups(docs, levels=levels, bucket_entries=entries).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == plain_variants(counts)


def test_variants_at_the_edges(edges, none):
    words = {r.word for r in spelling.variant_groups(edges).collect()}
    assert words == set()  # long runs come twice, others are short
    assert spelling.variant_groups(none).isEmpty()
    thrice = spelling.variant_groups(edges.unionAll(edges).unionAll(edges)).collect()
    assert {(r.word[0], len(r.word), r.n, r.form) for r in thrice} == {("x", 5_000, 3, None), ("y", 5_000, 3, None)}


def plain_set(text: str, size: int = 4) -> set[tuple[str, ...]]:
    words = WORDS.findall(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def plain_components(texts: dict[int, str]) -> dict[int, tuple[int, int]]:
    sets = {i: plain_set(t) for i, t in texts.items()}
    owners = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            owners[shingle].append(i)
    common: Counter[tuple[int, int]] = Counter()
    for group in owners.values():
        common.update((a, b) for k, a in enumerate(group) for b in group[k + 1:])
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), shared in common.items():
        if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_minhash_query_equals_plain_version(spark, folder, texts):
    expected = plain_components(texts)
    rows = QUERIES["op13_minhash_stars"](spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert any(not r.kept for r in rows)


def test_chains_and_short_texts_are_linked(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(10_000)}" for _ in range(120)]
    texts, words = {}, list(base)
    for i in range(60):  # each is near the one before, the ends are not alike
        words = list(words)
        words[draw.randrange(len(words))] = f"n{i}"
        texts[i - 30] = " ".join(words)
    texts |= {100: "a b", 101: "A  b", 102: "b a", 103: "", 104: "one two three four", 105: "ONE two three\nfour"}
    got = minhash.near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(texts)


def test_minhash_at_the_edges(edges, none):
    rows = minhash.near_copies(edges).collect()
    assert Counter(r.doc_id for r in rows) == Counter([*range(-2, 7), None])
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i for i in (-2, -1, 0))
    assert (by_id[2].component_id, by_id[4].component_id, by_id[None].component_id, by_id[None].kept) == (1, 3, None, True)
    assert minhash.near_copies(none).isEmpty()


def test_stars_bound_the_pairs(spark):
    one = spark.createDataFrame([(7, i, 10, i) for i in range(500)], "key long, rep long, n long, label long")
    assert minhash.star_edges(one, 1).count() == 499


def test_bitmaps_rule_out_no_link(spark):
    """Every pair of a group of texts near 0.6 to 0.9 to each other, by the join condition and exactly."""
    from tallymill.llm import bitmaps
    from pyspark.sql import functions as F

    draw = random.Random(9)
    base = list(range(100))
    rows = []
    for i in range(120):
        s = {x for x in base if draw.random() > draw.choice([0.02, 0.1, 0.2])}
        s |= {1000 + draw.randrange(300) for _ in range(draw.randrange(12))}
        rows.append((i, len(s), sorted(s)))
    sets = spark.createDataFrame(rows, "rep long, n long, hashes array<long>")
    left = sets.select("rep", "n").join(bitmaps.bitmaps_of(sets), "rep")
    right = left.select(*(F.col(c).alias(f"{c}_2") for c in left.columns))
    passed = {(r[0], r[1]) for r in left.join(right, F.col("rep") < F.col("rep_2")).filter(
        bitmaps.may_link()).select("rep", "rep_2").collect()}
    linked = {(a[0], b[0]) for k, a in enumerate(rows) for b in rows[k + 1:]
              if 100 * len(shared := {*a[2]} & {*b[2]}) >= 80 * (a[1] + b[1] - len(shared))}
    assert linked and linked <= passed and len(passed) < 120 * 119 // 4
