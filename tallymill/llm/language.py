"""Language by compression: the language whose text helps most to compress a document.

Each language's dictionary is raw text of that language. A document is
compressed in blocks with every dictionary, so that its own earlier text does
not take the dictionary's place; the smallest total wins. Close results are
marked as rejected.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import map_batches, row_hash

SAMPLE_DOCS = 64  # per language
SAMPLE_CHARS = 2000  # of each such document
BLOCK = 4096
MARGIN = 0.02
UNKNOWN = "und"
HAS_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def dictionaries(docs: DataFrame, training: Column, seed: int = 0) -> dict[str, bytes]:
    """Raw text per language: the first 2,000 characters of up to 64 training documents.

    The documents are the one with the smallest hash in each of 64 hash groups
    of a language, found with one small row per group; only their texts are
    fetched. This sample is all that the model learns from.
    """
    hashed = row_hash("doc_id", seed)
    marked = docs.filter(training & F.col("lang").isNotNull()).select(
        "lang", F.pmod(hashed, F.lit(SAMPLE_DOCS)).alias("part"), F.struct(hashed.alias("h"), "doc_id").alias("who")
    )
    chosen = marked.groupBy("lang", "part").agg(F.min("who").alias("who")).select(
        F.col("lang").alias("_lang"), F.col("who.doc_id").alias("_id")
    )
    picked = docs.join(
        F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))
    ).select("lang", "doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    texts: dict[str, dict[int, str]] = {}
    for row in picked.collect():
        texts.setdefault(row["lang"], {}).setdefault(row["doc_id"], row["text"] or "")
    return {
        lang: "\n".join(t for _, t in sorted(by_id.items())).lower().encode()
        for lang, by_id in sorted(texts.items()) if any(by_id.values())
    }


@lru_cache(maxsize=4)
def _compressors(samples: tuple[tuple[str, bytes], ...]) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, raw in samples:
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=3)
        out.append(zstandard.ZstdCompressor(dict_data=words, write_content_size=False))
    return out


def sizes(text: str, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    raw = text.lower().encode("utf-8", "surrogatepass")
    blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
    return np.array([sum(len(c.compress(b)) for b in blocks) for c in compressors], float)


def predict(text: str | None, samples: tuple[tuple[str, bytes], ...], margin: float = MARGIN) -> tuple[str, float, bool]:
    """Language, score in 0..1, and whether the margin to the next is too narrow.

    The score is the first one's share when each language weighs one half for
    every percent that it compresses worse than the best. Of equal sizes the
    language first by name wins.
    """
    if not text or not samples or not HAS_LETTER.search(text):
        return UNKNOWN, 0.0, True
    total = sizes(text, _compressors(samples))
    loss = total / total.min() - 1
    best = int(np.argmin(loss))
    others = np.delete(loss, best)
    narrow = bool(len(others)) and float(others.min()) < margin
    return samples[best][0], float(1 / np.sum(0.5 ** (100 * loss))), narrow


def identify(docs: DataFrame, training: Column | None = None) -> DataFrame:
    """Language of every document from its whole text; ``lang`` only serves to learn.

    Returns doc_id, held_out, lang_pred, score, rejected. A text that is NULL,
    empty or without a letter is ``und`` with score 0 and rejected; so is every
    text if nothing could be learnt. ``rejected`` marks margins under 2 %;
    their best guess is still given. Repeated rows are predicted alike; other
    columns are not read; an empty table gives no rows. The languages learnt
    are the values of ``lang``, which are taken to be few.
    """
    rule = ~held_out(F.col("doc_id")) if training is None else training
    samples = tuple(dictionaries(docs.select("doc_id", "text", "lang"), rule).items())
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")

    def work(batch: dict[str, list]) -> dict:
        found = [predict(text, samples) for text in batch["text"]]
        return {
            "doc_id": batch["doc_id"], "held_out": batch["held_out"],
            "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
            "rejected": [f[2] for f in found],
        }

    return map_batches(
        rows, work, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )
