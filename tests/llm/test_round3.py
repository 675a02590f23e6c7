"""What round 3 found in the text operators."""

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymill.llm import bpe, minhash
from tallymill.llm.bitmaps import bitmaps_of
from tallymill.llm.common import text_rows
from tallymill.llm.queries import TOKENIZER as PATH

TEXTS = ["one two three two", "", "zwei öfter\U0001F600 one", "one", "\ud800 two two"]


def library(texts):
    coder = Tokenizer.from_file(PATH)
    return [coder.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_of_one_hash_keep_their_ids(monkeypatch):
    coder = bpe.Codec(PATH)
    monkeypatch.setattr(bpe, "word_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    texts = [t for t in TEXTS if "\ud800" not in t]
    for part in (texts, texts[::-1]):
        assert [x.tolist() for x in coder.encode(part)] == library(part)


def test_cached_words_are_told_by_their_bytes():
    coder = bpe.Codec(PATH)
    first = [x.tolist() for x in coder.encode(TEXTS)]
    again = [x.tolist() for x in coder.encode(TEXTS[::-1])][::-1]
    assert first == again and first[:4] == library(TEXTS[:4])
    assert len(coder.hashes) == len(coder.slots) == len(coder.spelt[0]) - 1 == len(coder.ids[0]) - 1


def test_cache_is_emptied_at_its_limit(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 2)
    coder = bpe.Codec(PATH)
    for _ in range(3):
        assert [x.tolist() for x in coder.encode(TEXTS[:4])] == library(TEXTS[:4])
    assert len(coder.hashes) < 10


def test_a_pair_of_many_shared_buckets_is_met_once(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [words, [*words[:10], "x", *words[11:]], [*words[:300], *(f"v{i}" for i in range(100))]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sizes = minhash.sketched(text_rows(docs)).withColumnRenamed("doc_id", "rep").withColumn("label", F.col("rep"))
    placed = sizes.select("rep", "n", "label", "bands", F.explode("bands").alias("key"))
    members = sizes.select("rep")
    bitmaps = bitmaps_of(minhash.full_sets(text_rows(docs), members))
    pairs = [(r.x, r.y) for r in minhash.rest_of_buckets(minhash.undecided(placed), bitmaps).collect()]
    assert (0, 1) in pairs and len(pairs) == len(set(pairs))
