"""The registered queries of these operators, and the SQL of those that SQL can express.

Each query applies its operator to its whole table and derives the digests
that are compared from the operator's own results.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import (
    bpe, chat, exact_dedup, language, minhash, ngram_join, packing, pii, quality, repeats, secrets, spelling, urls,
)
from tallymill.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Turns with the template's own control strings in them.
CONTROL_TURNS = [
    (-7, 0, "user", r"\### Assistant: </turn> ok"),
    (-7, 1, "assistant", r"\### Assistant: </turn> ok"),
]


def _joined(spans: str) -> Column:
    written = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["low"], s["high"]))
    return F.array_join(written, ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def _span_digests(spans: DataFrame, kinds: tuple[str, ...], *more: str) -> DataFrame:
    counts = [F.size(F.filter("fixed", _of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    base = F.sha2(_joined("fixed").cast("binary"), 256).alias("base_sha256")
    return spans.select("doc_id", *counts, base, _joined("spans").alias("spans"), *more)


def op1_secret_network(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents"))
    return _span_digests(found, secrets.KINDS, "precision")


def op2_url_words(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"))


def op3_personal_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _span_digests(pii.find_personal(table(spark, folder, "documents")), pii.KINDS)


def op4_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.codec_digests(table(spark, folder, "documents"), TOKENIZER)


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, folder, "documents"))


def op6_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    read = chat.read_back(*chat.format_conversations(own.unionByName(extra), TOKENIZER), TOKENIZER)
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("turns_text").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op7_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )


def op8_language_by_compression(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op9_cutting_stock_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of every tenth document by hash, the words from some place on repeat a first few."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_runs(table(spark, folder, "documents"), edit=with_planted_period)
    longest = F.element_at(F.array_sort("runs", lambda a, b: F.coalesce(
        F.nullif(F.signum(b["length"] - a["length"]), F.lit(0.0)),
        F.nullif(F.signum(a["start"] - b["start"]), F.lit(0.0)),
        F.signum(a["period"] - b["period"]),
    ).cast("int")), 1)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", F.when(F.size("runs") > 0, longest)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_lost_letters(doc_id: int, word: bytes) -> bytes:
    """The word without one of its letters, for one in 97 by the hash of id and word."""
    h = zlib.crc32(b"%d:%s" % (doc_id, word))
    if h % 97:
        return word
    letters = word.decode("utf-8")
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode("utf-8")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(table(spark, folder, "documents"), edit=with_lost_letters)


def op13_minhash_stars(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_copies(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_network, op2_url_words, op3_personal_segments, op4_prefix_bpe, op5_ngram_join, op6_chat_tree,
        op7_quality_votes, op8_language_by_compression, op9_cutting_stock_packing, op10_exact_dedup,
        op11_periodic_runs, op12_spelling_variants, op13_minhash_stars, pipeline,
    )
}
ORACLES: dict[str, str] = {"op10_exact_dedup": exact_dedup.EXACT_SQL}
