"""Words that collide under a linear hash, and counters beyond what a summary takes."""

from __future__ import annotations

import hashlib
import struct
import warnings
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallymill.llm import bpe, exact_dedup, ngram_join, packing, quality
from tallymill.llm.common import number_lists
from tallymill.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(letters: int) -> tuple[str, str]:
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(letters))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.fixture(scope="module")
def crafted(spark):
    rows = []
    for letters in (1024, 2048, 4096):
        rows += [f"{w} q" for w in thue_morse(letters)]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)


def library_ids(text: str) -> list[int]:
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_crafted_words_keep_their_ids(crafted):
    texts = {r.doc_id: r.text for r in crafted.collect()}
    for r in bpe.encode_decode(crafted, PATH).collect():
        assert r.ids == library_ids(texts[r.doc_id]) and r.decoded == texts[r.doc_id]
    pieces: dict[int, dict[int, tuple]] = {}
    for r in packing.pack(crafted, PATH).collect():
        ids = [*library_ids(texts[r.doc_id]), 1]
        part = ids[r.start:r.start + r.length]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_crafted_words_do_not_link(crafted):
    assert all(r.component_id == r.doc_id for r in ngram_join.near_groups(crafted).collect())
    one, other = thue_morse(1024)
    seven = "a1 b2 c3 d4 e5 f6 g7"
    assert quality.measure([f"{one} {seven} {other} {seven}"])["n_repeat_words"] == [0]


def test_many_special_tokens_are_cut_once():
    text = "<|endoftext|>x" * 20_000
    special = dict.fromkeys(library_ids("<|endoftext|>x"))
    assert [*dict.fromkeys(bpe.codec(PATH).encode([text])[0].tolist())] == [*special]


@pytest.mark.parametrize("partitions", ["1", "2501", "20000"])
def test_counters_at_any_number_of_partitions(spark, folder, partitions):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = sorted(map(tuple, exact_dedup.exact_groups(docs, counters=1024).collect()))
    counters = max(1024, min(4 * int(partitions), exact_dedup.MOST_COUNTERS))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert exact_dedup.counters_for(docs) == counters
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, exact_dedup.exact_groups(docs, counters=counters).collect())) == expected


def test_registered_digests_equal_the_library(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    coder = Tokenizer.from_file(PATH)
    ids = {i: coder.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    for r in QUERIES["op4_prefix_bpe"](spark, folder).collect():
        own = ids[r.doc_id]
        assert r.n_tokens == len(own)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        plain = coder.decode(own, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()
    seen: Counter[int] = Counter()
    for r in QUERIES["op9_cutting_stock_packing"](spark, folder).collect():
        own = [*ids[r.doc_id], 1]
        part = own[r.start:r.start + r.length]
        seen[r.doc_id] += r.length
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    assert seen == {i: len(x) + 1 for i, x in ids.items()}


def test_helpers_take_any_column_names(spark):
    """Columns named like the helpers' own are kept, and the decisions are the same."""
    from tallymill.llm import pii

    names = ("_reject_id", "_measures", "_PATTERN", "n_words", "votes", "_drop_id", "_DROP_DIGEST", "_found_id", "_spans")
    prose = "The river ran past old houses, and people stood there to see it go by every day, said one. " * 3
    rows = [(1, f"{prose} Write to ann.b@example.org now."), (2, prose), (3, prose), (4, "# $ %"), (5, None)]
    docs = spark.createDataFrame(
        [(i, t, *("kept",) * len(names)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for helper in (quality.keep_good, exact_dedup.drop_exact_copies, ngram_join.drop_near_copies, pii.mask_personal):
        out = helper(docs)
        assert out.columns == docs.columns
        got = {r["doc_id"]: r for r in out.collect()}
        assert all(r[n] == "kept" for r in got.values() for n in names)
        if helper is exact_dedup.drop_exact_copies:
            assert set(got) == {1, 3, 4, 5}
        if helper is pii.mask_personal:
            assert "ann.b@" not in got[1]["text"] and got[2]["text"] == prose


def test_one_labelled_window_trains_a_field(spark):
    from tallymill.llm import pii

    docs = spark.createDataFrame([(1, "mail ann.b@example.org please"), (2, "at 12 o'clock"), (3, "")], "doc_id long, text string")
    assert pii.train(pii.found(docs)) is not None
    assert pii.train(pii.found(docs.filter("doc_id > 1"))) is None


def test_registered_chat_digests_from_the_table(spark, folder):
    from tallymill.llm.queries import CONTROL_TURNS

    conversations: dict = {}
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    for c, turn, role, text in [*map(tuple, rows), *CONTROL_TURNS]:
        conversations.setdefault(c, []).append((turn, role or "", text or ""))
    got = {r.conv_id: r for r in QUERIES["op6_chat_tree"](spark, folder).collect()}
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_word_hashes_tell_words_apart():
    import itertools

    from tallymill.llm.common import LONG_WORD, Words

    pad = "a" * (LONG_WORD - 6)
    words = ["".join(w) for k in range(1, 11) for w in itertools.product("ab", repeat=k)]
    words += [pad + w for w in words] + ["\x00", "\x00\x00", "é", "e"]
    one_by_one = [int(Words([w]).hash[0]) for w in words]
    assert len(set(one_by_one)) == len(set(words))
    assert Words([" \t".join(words)]).hash.tolist() == one_by_one


def test_every_row_is_masked_by_its_own_text(spark):
    """Rows without an id, and two texts of one id; other columns of many types pass; no text is shuffled."""
    from tallymill.llm import pii

    rows = [(None, "mail ann.b@example.org now", 1), (7, "at 10.0.0.1 it is", 2), (7, "or bob@example.net there", 3), (8, None, 4), (9, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").selectExpr(
        "doc_id", "n_chars AS place", "text", "n_chars", "timestamp'2024-05-06 07:08:09' AS seen_at",
        "array(cast(doc_id AS decimal(20,3))) AS listed", "map('k', doc_id) AS spans",
    )
    out = pii.mask_personal(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    before, got = ({r.place: r for r in df.collect()} for df in (docs, out))
    assert {i: r.text for i, r in got.items()} == {1: "mail <EMAIL> now", 2: "at <IP> it is", 3: "or <EMAIL> there", 4: None, 5: ""}
    for i, r in got.items():
        assert r.n_chars == (None if r.text is None else len(r.text))
        assert all(r[c] == before[i][c] for c in ("doc_id", "seen_at", "listed", "spans"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert pii.mask_personal(docs.filter("place > 9")).isEmpty()


def test_number_lists_are_the_rows_of_any_slice():
    rows = [[3, 1], [], [-5], [7, 8, 9], []]
    for low in range(6):
        for high in range(low + 1, 6):
            column = pa.array(rows, pa.list_(pa.int64())).slice(low, high - low)
            assert [r.tolist() for r in number_lists(column)] == rows[low:high]


def test_every_row_is_kept_by_its_own_text(spark):
    """Rows without an id and rows that share one, good and bad texts among both."""
    prose = "The river ran past old houses, and people stood there to see it go by every day, said one of them."
    rows = [(None, prose), (None, "# $ %"), (7, prose + " So it was."), (7, None), (7, ""), (8, "few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in quality.keep_good(docs).collect()} == {rows[0], rows[2]}
    assert quality.keep_good(docs.limit(0)).isEmpty()
    assert "Exchange hashpartitioning" not in quality.keep_good(docs)._jdf.queryExecution().toString()


def test_an_early_end_of_column_generation_is_reported():
    demand = np.arange(1, 33)
    with pytest.warns(UserWarning, match="after 1 rounds"):
        early = packing.fractional_patterns(demand, 40, rounds=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        whole = packing.fractional_patterns(demand, 40)
    assert (sum(p * n for p, n in early) >= demand - 1e-6).all()
    assert sum(n for _, n in whole) <= sum(n for _, n in early)
