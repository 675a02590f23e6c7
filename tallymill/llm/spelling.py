"""Groups of spelling variants: words one edit apart, and the frequent word each follows.

Letters fall into sixteen groups, and a word becomes the vector of how many
letters of each group it has. One inserted, deleted or replaced letter moves
the vector by a surplus of at most one and a deficit of at most one. The
vectors form a trie, one group a level. A search starts at the root with one
surplus and one deficit to spend, goes down depth first wherever the counts
differ by what is left, and at a leaf the words themselves are compared.

The upper levels of the trie are the shuffle key. Two words one edit apart have
a common floor there, the smaller count of each group, from which each is at
most one letter away; so a word goes to its own upper vector and to those with
one letter less, and every pair meets at exactly one key, with what it has
spent so far. Tasks send on counts and best partners of words, never pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import map_batches, text_rows
from tallymill.session import stored

#: Runs of a-z and of U+00C0 to U+00FF in UTF-8, after A-Z became a-z.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LEAST_CHARS, LEAST_COUNT = 5, 3
GROUPS = 16  # a letter's group is its code point modulo this
#: The order of the levels, groups with the most frequent letters first.
LEVELS = (5, 4, 1, 15, 9, 14, 3, 8, 2, 12, 13, 6, 7, 0, 11, 10)
BUCKET_ENTRIES = 1 << 15
CHUNK = 1 << 17  # states of the search, or pairs of words, at a time
WIDTH = 32  # words of more letters are compared one by one


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    edit: Callable[[int, bytes], bytes] | None = None,
) -> DataFrame:
    """``word`` and ``n`` (occurrences in all rows) of words with 5 letters and 3 occurrences or more.

    ``edit`` may respell a document's words first. Counts are added up within a
    batch and a task before the shuffle.
    """
    def work(batch: dict[str, list]) -> dict:
        total: Counter[bytes] = Counter()
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            own = Counter(RUN.findall(text.encode("utf-8").lower()))
            if edit and doc_id is not None:
                for word, n in own.items():
                    total[edit(doc_id, word)] += n
            else:
                total.update(own)
        return {"word": [w.decode("utf-8") for w in total], "n": list(total.values())}

    counted = map_batches(text_rows(docs, id_col, text_col), work, "word string, n long")
    return counted.filter(F.char_length("word") >= LEAST_CHARS).groupBy("word").agg(
        F.sum("n").alias("n")
    ).filter(F.col("n") >= LEAST_COUNT)


def letter_counts(words: Sequence[str]) -> np.ndarray:
    """The vector of each word, its levels in search order."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in words])
    place = np.repeat(np.arange(len(words)), sizes) * GROUPS + codes % GROUPS
    counts = np.bincount(place, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return counts[:, LEVELS].astype(np.int32)


def levels_for(words: int) -> int:
    """How many levels make the key, so that a key's share falls as the vocabulary grows."""
    return min(GROUPS, max(3, round(np.log2(words + 1) / 2.5)))


def dealt(words: DataFrame, levels: int) -> DataFrame:
    """Each word at its own upper vector (part 0) and at those with one letter less (part 1 + level)."""
    def work(batch: dict[str, list]) -> dict:
        upper = letter_counts(batch["word"])[:, :levels]
        row, level = np.nonzero(upper)
        keys = np.concatenate([upper, upper[row]])
        keys[len(upper) + np.arange(len(row)), level] -= 1
        at = np.concatenate([np.arange(len(upper)), row])
        packed = np.ascontiguousarray(keys.astype("<i4"))
        return {
            "key": [k.tobytes() for k in packed],
            "part": np.concatenate([np.zeros(len(upper), np.int64), level + 1]).tolist(),
            "word": [batch["word"][i] for i in at.tolist()],
            "n": [batch["n"][i] for i in at.tolist()],
        }

    return map_batches(words, work, "key binary, part int, word string, n long")


class Trie:
    """The entries (key, part, lower vector) of one bucket, and the pairs of leaves in reach."""

    def __init__(self, key: np.ndarray, part: np.ndarray, lower: np.ndarray, parts: int):
        self.parts, self.width = parts, int(lower.max(initial=0)) + 3
        self.codes: list[np.ndarray] = []
        node = self._level(key * parts + part)
        for level in range(lower.shape[1]):
            node = self._level(node * self.width + lower[:, level] + 1)
        self.order = np.argsort(node, kind="stable")  # entries by leaf
        self.first = np.searchsorted(node[self.order], np.arange(len(self.codes[-1]) + 1))
        some = self.order[self.first[:-1]]
        self.key, self.part, self.lower = key[some], part[some], lower[some]

    def _level(self, codes: np.ndarray) -> np.ndarray:
        distinct, node = np.unique(codes, return_inverse=True)
        self.codes.append(distinct)
        return node.astype(np.int64)

    def _at(self, level: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.codes[level]
        node = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return node, known[node] == codes

    def _roots(self):
        """The searches of all leaves: below their key, with what the two parts leave of the budget."""
        leaf = np.arange(len(self.key))
        for other in range(self.parts):
            node, there = self._at(0, self.key * self.parts + other)
            # every pair of parts once; two words at a letter's distance by the same letter meet elsewhere
            there &= (self.part < other) | ((self.part == 0) & (other == 0))
            at = leaf[there]
            yield 0, at, node[there], np.full(len(at), other == 0), self.part[at] == 0

    def pairs(self):
        """(leaf, leaf) within a surplus and a deficit of one, in blocks; every pair once."""
        depth = self.lower.shape[1]
        stack = list(self._roots())
        while stack:
            level, leaf, node, surplus, deficit = stack.pop()
            if len(leaf) > CHUNK:
                half = len(leaf) // 2
                for cut in (slice(half), slice(half, None)):
                    stack.append((level, leaf[cut], node[cut], surplus[cut], deficit[cut]))
                continue
            if level == depth:
                once = (self.part[leaf] != self.part[node]) | (leaf <= node)
                yield leaf[once], node[once]
                continue
            own = node * self.width + self.lower[leaf, level] + 1
            states = []
            for step, may in ((0, None), (1, surplus), (-1, deficit)):
                at = np.arange(len(leaf)) if may is None else np.flatnonzero(may)
                below, there = self._at(level + 1, own[at] + step)
                at = at[there]
                states.append((leaf[at], below[there], surplus[at] & (step != 1), deficit[at] & (step != -1)))
            stack.append((level + 1, *map(np.concatenate, zip(*states))))

    def entry_pairs(self):
        """Pairs of entries of the leaf pairs, in blocks of about ``CHUNK``."""
        size = np.diff(self.first)
        for a, b in self.pairs():
            product = size[a] * size[b]
            upto = np.cumsum(product)
            low = 0
            while low < len(a):
                reached = upto[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(upto, reached + CHUNK, side="right")))
                rows = np.repeat(np.arange(low, high), product[low:high])
                place = np.arange(len(rows)) + reached - (upto - product)[rows]
                i = self.order[self.first[a[rows]] + place // size[b[rows]]]
                j = self.order[self.first[b[rows]] + place % size[b[rows]]]
                once = (a[rows] != b[rows]) | (i < j)
                yield i[once], j[once]
                low = high


def _one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


class Spelled:
    """Words as rows of code points, to compare many pairs at a time."""

    def __init__(self, words: Sequence[str]):
        self.words, self.size = words, np.array([len(w) for w in words])
        short = np.array([w if len(w) <= WIDTH else "" for w in words], f"U{WIDTH + 1}")
        self.codes = short.view(np.uint32).reshape(len(words), WIDTH + 1)

    def one_edit(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether exactly one inserted, deleted or replaced letter parts each pair."""
        swap = self.size[i] > self.size[j]
        a, b = np.where(swap, j, i), np.where(swap, i, j)
        longer = self.size[b] - self.size[a]
        near = longer <= 1
        width = int(self.size[b].max(initial=0)) + 1
        far = np.flatnonzero(near & (self.size[b] > WIDTH))
        x, y = self.codes[a, :width], self.codes[b, :width]
        other = x != y
        replaced = other.sum(1) == 1
        after = np.logical_or.accumulate(other[:, :-1], axis=1)
        inserted = ~(after & (x[:, :-1] != y[:, 1:])).any(1)
        near &= np.where(longer == 0, replaced, inserted)
        for k in far.tolist():
            near[k] = _one_edit(self.words[a[k]], self.words[b[k]])
        return near


def near_words(table: pa.Table, levels: int) -> dict[str, list]:
    """Of each word of a bucket: how many of the bucket's words are near, and the best of these."""
    words = table.column("word").to_pylist()
    distinct, first, word = np.unique(np.array(words, object), return_index=True, return_inverse=True)
    names = distinct.tolist()
    n = np.array(table.column("n").to_pylist(), np.int64)[first]
    _, key = np.unique(np.array(table.column("key").to_pylist(), object), return_inverse=True)
    part = np.array(table.column("part").to_pylist(), np.int64)
    lower = letter_counts(names)[word][:, levels:].astype(np.int64)
    spelled = Spelled(names)
    rank = np.empty(len(names), np.int64)  # by count, then by code points
    order = np.lexsort((np.arange(len(names)), -n))
    rank[order] = np.arange(len(names))
    near, best = np.zeros(len(names), np.int64), np.full(len(names), len(names))
    for i, j in Trie(key.astype(np.int64), part, lower, levels + 1).entry_pairs():
        i, j = word[i], word[j]
        true = spelled.one_edit(i, j)
        i, j = i[true], j[true]
        for x, y in ((i, j), (j, i)):
            near += np.bincount(x, minlength=len(names))
            np.minimum.at(best, x, rank[y])
    has = best < len(names)
    form = order[np.where(has, best, 0)]
    return {
        "word": names, "n": n.tolist(), "n_near": near.tolist(),
        "best_n": [int(n[f]) if h else None for f, h in zip(form.tolist(), has.tolist())],
        "best": [names[f] if h else None for f, h in zip(form.tolist(), has.tolist())],
    }


def partners(words: DataFrame, levels: int | None = None, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """``word``, ``n``, ``n_near``, and ``best`` / ``best_n``: the near word of largest count, then smallest spelling."""
    levels = levels or levels_for(words.count())
    entries = stored(dealt(words, levels), "spelling-entries")
    buckets = 1 + entries.count() // bucket_entries
    schema = "word string, n long, n_near long, best_n long, best string"

    def search(table: pa.Table) -> pa.Table:
        return pa.table(near_words(table, levels), schema=arrow)

    arrow = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()),
                       ("best_n", pa.int64()), ("best", pa.string())])
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    found = entries.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(search, schema)
    # of the largest count the smallest word: strings compare by UTF-8 bytes, as code points do
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of all words with a form (word, form): each round doubles the steps taken.

    Counts at least double from a word to its form, so there are no circles and
    the rounds are few.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = steps.join(on, F.col("root") == F.col("_at"), "left")
        steps = stored(moved.select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
        ), "spelling-roots")
        if steps.filter("moved").isEmpty():
            return steps.drop("moved")
        steps = steps.drop("moved")


def variant_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    edit: Callable[[int, bytes], bytes] | None = None,
    levels: int | None = None, bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word.

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z as a-z) of 5 code
    points or more that comes 3 times or more in all rows. Its form is the near
    word (one edit) of largest count if that is at least twice its own; the root
    follows the forms to the last. NULL and empty texts have no words; repeated
    rows count again; a row without an id is counted unedited; other columns
    are not read; an empty table gives no rows.
    """
    words = stored(word_counts(docs, id_col, text_col, edit), "spelling-words")
    follows = F.col("best_n") >= 2 * F.col("n")
    formed = stored(partners(words, levels, bucket_entries).select(
        "word", F.when(follows, F.col("best")).alias("form"), "n", "n_near",
        F.when(follows, F.col("best_n")).alias("form_n"),
    ), "spelling-forms")
    last = roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
