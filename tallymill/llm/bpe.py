"""Byte-pair encoding by a table over prefixes, and decoding.

For every prefix of a word the table holds the last token of the prefix's
encoding, which is unique. A suffix automaton (Aho-Corasick over the
vocabulary's bytes) lists the tokens that end at a place; the right one is the
token that can stand after the last token of the prefix before it. Following
the entries back from the word's end gives the ids.

Two tokens can stand side by side if no merge joins the symbols that meet at
their border before these are merged into the tokens themselves. At each
moment the symbol at the left of the border is on the right spine of the first
token's merge tree, and the symbol at its right on the left spine of the
second's.

Words are found and told apart with array operations on a block of texts; each
distinct word is encoded once per worker while it is in the bounded cache, which
holds its hash, its bytes and its ids in plain arrays. A word is taken from the
cache only if its bytes are those kept there.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from tallymill.llm.common import U64, gather, map_batches, text_blocks, text_rows, word_hashes

CACHED_WORDS = 500_000
CACHED_PAIRS = 500_000
LETTER, NUMBER, OTHER, SPACE = range(4)
#: White space of the Unicode character database, fixed values.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        group = unicodedata.category(chr(code))[0]
        if group in "LN":
            kinds[code] = LETTER if group == "L" else NUMBER
    kinds[list(WHITE)] = SPACE
    return kinds


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """One vocabulary file in the tokenizers library's JSON form (byte level)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        size = 1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])])
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(letters.__getitem__, token))
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, longest_first)) or "(?!)")
        self.rank: dict[int, int] = {}
        left, right, made = [-1] * size, [-1] * size, [-1] * size
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            self.rank[x << 20 | y] = rank
            if made[t] < 0:
                left[t], right[t], made[t] = x, y, rank
        never = len(merges)
        self.right_spine = [self._spine(t, right, made, never) for t in range(size)]
        self.left_spine = [self._spine(t, left, made, never) for t in range(size)]
        self.automaton = ahocorasick.Automaton()
        for t in vocab.values():
            x, y = left[t], right[t]
            if x < 0 or self._border_holds(x, y, made[t]):
                self.automaton.add_word(self.bytes[t].decode("latin-1"), t)
        self.automaton.make_automaton()
        self.length = [len(b) for b in self.bytes]
        self.pairs: dict[int, bool] = {}
        digits = [b"%d," % i for i in range(size)]
        self.byte_table, self.digit_table = self._flat(self.bytes), self._flat(digits)
        self.kinds = character_kinds()
        self.clear()

    @staticmethod
    def _spine(t: int, child: list[int], made: list[int], never: int) -> list[tuple[int, int]]:
        """The border symbols of a token, and the rank of the merge that ends each."""
        spine, ends = [], never
        while t >= 0:
            spine.append((t, ends))
            ends, t = made[t], child[t]
        return spine

    @staticmethod
    def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = np.array([len(p) for p in parts])
        return np.cumsum(counts) - counts, counts, np.frombuffer(b"".join(parts), np.uint8)

    def _border_holds(self, a: int, b: int, below: int) -> bool:
        """No merge of rank under ``below`` joins the two across their border.

        Of two merges of one rank the left one is first.
        """
        for x, x_ends in self.right_spine[a]:
            for y, y_ends in self.left_spine[b]:
                rank = self.rank.get(x << 20 | y, below)
                if rank < below and rank < x_ends and rank <= y_ends:
                    return False
        return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._border_holds(a, b, len(self.rank))
        return known

    def encode_words(self, words: Sequence[bytes]) -> list[list[int]]:
        """The ids of each word. In order, a word takes the entries of the prefix it shares with the one before."""
        length, known, fits = self.length, self.pairs.get, self.fits
        out: list[list[int]] = [[]] * len(words)
        before, last = "", []
        for i in sorted(range(len(words)), key=words.__getitem__):
            raw = words[i].decode("latin-1")
            shared = 0
            for a, b in zip(raw, before):
                if a != b:
                    break
                shared += 1
            last = [*last[:shared], *[-1] * (len(raw) - shared)]  # by the place where a prefix ends
            for at, token in self.automaton.iter(raw):
                if last[at] < 0:
                    start = at + 1 - length[token]
                    if start:
                        fit = known(last[start - 1] << 20 | token)
                        if fit is None:
                            fit = fits(last[start - 1], token)
                        if not fit:
                            continue
                    last[at] = token
            before, ids, at = raw, [], len(raw) - 1
            while at >= 0:
                ids.append(last[at])
                at -= length[last[at]]
            out[i] = ids[::-1]
        return out

    def clear(self) -> None:
        """Empty the cache: hashes in order with the slot of each, and bytes and ids by slot."""
        self.hashes, self.slots = np.empty(0, U64), np.empty(0, np.int64)
        self.spelt, self.ids = (np.zeros(1, np.int64), np.empty(0, np.uint8)), (np.zeros(1, np.int64), np.empty(0, np.int32))

    def word_starts(self, codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """True where a word of the vocabulary's splitting pattern begins.

        Runs of letters, of numbers and of other signs take one space before
        them; a run of white space before something else leaves its last
        character; an apostrophe alone takes the ending after it.
        """
        n = len(codes)
        kind = self.kinds[codes]
        fresh = np.ones(n + 1, bool)
        fresh[1:n] = kind[1:] != kind[:-1]
        fresh[begin] = True
        run = np.flatnonzero(fresh[:n])
        stop = np.append(run[1:], n)
        closed = np.zeros(n + 1, bool)  # a text begins here
        closed[begin] = closed[n] = True
        out = fresh[:n].copy()
        gaps = (kind[run] == SPACE) & ~closed[stop]
        tail = stop[gaps] - 1
        out[tail] = True
        joined = stop[gaps][codes[tail] == 0x20]
        out[joined] = False
        alone = (codes[run] == 0x27) & (stop - run == 1) & ~closed[stop] & out[run]
        mark = run[alone]
        mark = mark[kind[mark + 1] == LETTER]
        word_end = stop[np.searchsorted(run, mark + 1)] if len(mark) else mark
        one, two = codes[mark + 1], codes[np.minimum(mark + 2, n - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        long = (word_end - mark > 2) & np.any([(one == a) & (two == b) for a, b in pairs], axis=0)
        took = np.where(short, 2, np.where(long, 3, 0))
        mark, word_end, took = mark[took > 0], word_end[took > 0], took[took > 0]
        out[mark + 1] = False
        rest = mark + took
        out[rest[rest < word_end]] = True
        return out

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin, one entry more than words, and all ids."""
        ids = self.encode_words(words)
        ends = np.cumsum([0, *map(len, ids)])
        return ends, np.fromiter(itertools.chain.from_iterable(ids), np.int32, ends[-1])

    def slots_of(self, data: np.ndarray, size: np.ndarray) -> np.ndarray | None:
        """The slot of each of the words, of ``size`` bytes, that make up ``data``; all are cached then.

        None if two different words, of these or the cached, have one hash.
        """
        if len(self.hashes) > CACHED_WORDS:
            self.clear()
        stop = np.cumsum(size)
        start = stop - size
        hashes, first, place = np.unique(word_hashes(data, start, stop), return_index=True, return_inverse=True)
        own, length = start[first], size[first]
        at = np.searchsorted(self.hashes, hashes)
        fresh = np.append(self.hashes, U64(0))[at] != hashes
        fresh |= at == len(self.hashes)
        slot = np.append(self.slots, 0)[at]
        slot[fresh] = len(self.slots) + np.arange(fresh.sum())
        if fresh.any():
            spelt = gather(own[fresh], length[fresh], data)
            ends = np.cumsum(np.append(0, length[fresh]))
            raw = spelt.tobytes()
            ids = self.encoded([raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
            self.spelt, self.ids = (
                (np.append(old[0], old[0][-1] + new[0][1:]), np.append(old[1], new[1]))
                for old, new in ((self.spelt, (ends, spelt)), (self.ids, ids))
            )
            self.hashes = np.insert(self.hashes, at[fresh], hashes[fresh])
            self.slots = np.insert(self.slots, at[fresh], slot[fresh])
        slot = slot[place]
        begin, letters = self.spelt
        kept = begin[slot + 1] - begin[slot]
        if np.array_equal(kept, size) and np.array_equal(gather(begin[slot], kept, letters), data):
            return slot
        return None

    def one_by_one(self, data: np.ndarray, size: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """The ids of the distinct words, and which of them each word is, without hashes and cache."""
        ends, raw, seen = np.cumsum(size).tolist(), data.tobytes(), {}
        slot = [seen.setdefault(raw[a:b], len(seen)) for a, b in zip([0, *ends], ends)]
        return self.encoded(list(seen)), np.array(slot)

    def encode_block(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text, special tokens' strings not looked for."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        if not len(codes):
            return [np.empty(0, np.int32) for _ in texts]
        begin = (ends - sizes)[sizes > 0]
        start = np.flatnonzero(self.word_starts(codes, begin))
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        width = np.ones(len(codes), np.uint8)
        for least in (0x80, 0x800, 0x10000) if len(data) > len(codes) else ():
            width += codes >= least
        size = np.add.reduceat(width, start, dtype=np.int64)
        slot = self.slots_of(data, size)
        (offsets, flat), slot = (self.ids, slot) if slot is not None else self.one_by_one(data, size)
        word_first, word_size = offsets[slot], offsets[slot + 1] - offsets[slot]
        ids = gather(word_first, word_size, flat)
        upto = np.concatenate([[0], np.cumsum(word_size)])[np.searchsorted(start, ends)]
        return np.split(ids, upto[:-1])

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text; strings of special tokens become their ids."""
        out: list[np.ndarray] = []
        for low, high in text_blocks(texts):
            block = list(texts[low:high])
            hit = [i for i, t in enumerate(block) if self.special_pattern.search(t)]
            parted = {i: self._parted(block[i]) for i in hit}
            for i in hit:
                block[i] = ""
            ids = self.encode_block(block)
            for i, parts in parted.items():
                plain = iter(self.encode_block([p for p in parts if isinstance(p, str)]))
                ids[i] = np.concatenate([
                    next(plain) if isinstance(p, str) else np.array([p], np.int32) for p in parts
                ])
            out += ids
        return out

    def _parted(self, text: str) -> list[str | int]:
        """The text cut at special tokens: the first to begin, then the longest."""
        parts: list[str | int] = []
        low = 0
        for found in self.special_pattern.finditer(text):
            parts += [text[low:found.start()], self.special[found[0]]]
            low = found.end()
        return [*parts, text[low:]]

    def decode(self, ids: np.ndarray) -> str:
        first, count, flat = self.byte_table
        return gather(first[ids], count[ids], flat).tobytes().decode("utf-8", "replace")

    def digits(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        first, count, flat = self.digit_table
        return gather(first[ids], count[ids], flat).tobytes()[:-1]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the ids of its whole text and what they decode to.

    NULL and empty texts give no ids and an empty text. Rows are independent:
    repeated rows repeat, other columns are not read, and an empty table gives
    no rows. A text of any length is encoded whole.
    """
    def work(batch: dict[str, list]) -> dict:
        coder = codec(path)
        ids = coder.encode(batch["text"])
        return {"doc_id": batch["doc_id"], "ids": ids, "decoded": [coder.decode(x) for x in ids]}

    return map_batches(
        text_rows(docs, id_col, text_col), work, "doc_id long, ids array<int>, decoded string"
    )


def codec_digests(docs: DataFrame, path: str) -> DataFrame:
    """``encode_decode`` with its two results as digests, made in the same task."""
    def work(batch: dict[str, list]) -> dict:
        coder = codec(path)
        ids = coder.encode(batch["text"])
        return {
            "doc_id": batch["doc_id"],
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(coder.digits(x)).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(coder.decode(x).encode()).hexdigest() for x in ids],
        }

    return map_batches(
        text_rows(docs), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
