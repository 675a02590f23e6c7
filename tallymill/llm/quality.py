"""Quality rules as weak supervision.

Each rule looks at one measure of a text and votes for good, for bad, or not
at all. The rules' accuracies are not given: expectation-maximisation finds
them from how the votes of all documents agree. The posterior probability of
being good then decides, so one failed rule does not reject a document.

Documents with the same votes count together, so the estimate is exact over
all rows and needs one small row per pattern of votes (at most 3 to the power
of the number of rules).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallymill.llm.common import Words, free_name, map_batches, slices, text_blocks, text_rows
from tallymill.session import stored

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Votes good at or under ``good``, bad over ``bad``, and abstains elsewhere.

    Most rules only accuse: passing one says little about a text.
    """

    name: str
    measure: str
    good: float | None
    bad: float | None


#: Measures are shares of words or lines, so the same rules suit any length.
RULES = (
    Rule("symbols", "n_symbols / n_words", None, 0.3),
    Rule("marked_words", "n_marked_words / n_words", None, 0.3),
    Rule("no_letters", "n_plain_words / n_words", None, 0.3),
    Rule("repeated_words", "n_repeat_words / n_words", None, 0.3),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.3),
    Rule("shouting", "n_upper_words / n_words", None, 0.5),
    Rule("exclamations", "n_exclaimed / n_words", None, 0.3),
    Rule("long_words", "word_chars / n_words", None, 14.0),
    Rule("sentences", "n_words / n_stopped", 30.0, None),
    Rule("ordinary_words", "n_words / n_ordinary", 1.4, None),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_marked_words", "n_plain_words", "n_upper_words", "n_exclaimed", "n_stopped", "n_ordinary")


def _members(signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(signs)] = True
    return out


IS_SYMBOL, IS_UPPER, IS_LOWER = _members(SYMBOLS), _members(bytes(range(65, 91))), _members(bytes(range(97, 123)))
IS_STOP = _members(b".,;:?")
IS_CONTINUED = _members(bytes(range(0x80, 0xC0)))
IS_LETTER = IS_UPPER | IS_LOWER | _members(bytes(range(0x80, 0x100)))


def measure(texts: Sequence[str]) -> dict[str, list[int]]:
    """The counts of each text, by array operations on blocks of texts."""
    out: dict[str, list[int]] = {name: [] for name in COUNTS}
    for low, high in text_blocks(texts):
        words, n = Words(texts[low:high]), high - low
        upto = lambda flags: np.concatenate([[0], np.cumsum(flags)])

        def inside(flags: np.ndarray) -> np.ndarray:
            sums = upto(flags)
            return sums[words.end] - sums[words.start]

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(words.doc, values, n).astype(np.int64)

        data, ones = words.data, np.ones(len(words.doc), np.int64)
        upper, lower = inside(IS_UPPER[data]), inside(IS_LOWER[data])
        marked, last = inside(IS_SYMBOL[data]) > 0, data[words.end - 1]
        letters = inside(IS_LETTER[data])
        out["n_words"] += per_text(ones).tolist()
        out["word_chars"] += per_text(words.end - words.start - inside(IS_CONTINUED[data])).tolist()
        signs = upto(IS_SYMBOL[data])
        out["n_symbols"] += (signs[words.begin[1:] - 1] - signs[words.begin[:-1]]).tolist()
        out["n_upper_words"] += per_text((upper > 1) & (lower == 0)).tolist()
        out["n_marked_words"] += per_text(marked).tolist()
        out["n_plain_words"] += per_text(letters == 0).tolist()
        out["n_exclaimed"] += per_text(last == ord("!")).tolist()
        out["n_stopped"] += per_text(IS_STOP[last]).tolist()
        out["n_ordinary"] += per_text(~marked & (letters > 0) & (upper < 2)).tolist()
        out["n_repeat_words"] += per_text(_in_repeats(words)).tolist()
        for text in texts[low:high]:
            lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
            out["n_lines"].append(len(lines))
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
    return out


def _in_repeats(words: Words) -> np.ndarray:
    """Which words lie in a window that its text has twice or more."""
    hashes, first = words.windows(REPEAT_WINDOW)
    marks = np.zeros(len(words.hash) + 1, np.int64)
    if len(hashes):
        doc = words.doc[first]
        order = np.lexsort((hashes, doc))
        twin = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        again = np.zeros(len(order), bool)
        again[1:] |= twin
        again[:-1] |= twin
        places = first[order[again]]
        np.add.at(marks, places, 1)
        np.add.at(marks, places + REPEAT_WINDOW, -1)
    return np.cumsum(marks)[:-1] > 0


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)
    return map_batches(
        text_rows(docs, id_col, text_col),
        lambda batch: {"doc_id": batch["doc_id"], **measure(batch["text"])}, schema,
    )


def measured(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with each text's counts as the struct ``name``."""
    place = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = measure([text or "" for text in batch.column(place).to_pylist()])
            column = pa.StructArray.from_arrays([pa.array(counts[c], pa.int64()) for c in COUNTS], COUNTS)
            yield batch.append_column(name, column)

    own = [StructField(f.name, f.dataType) for f in docs.schema]
    counts = StructType([StructField(c, LongType()) for c in COUNTS])
    return docs.mapInArrow(run, StructType([*own, StructField(name, counts)]))


def votes(rules: Sequence[Rule] = RULES, within: str = "") -> Column:
    """One of +, - and 0 per rule; a measure without words or lines abstains.

    ``within`` stands before the names of the counts, for those in a struct.
    """
    def vote(rule: Rule) -> Column:
        above, below = rule.measure.split(" / ")
        share = F.expr(f"{within}{above} / nullif({within}{below}, 0)")
        good = F.lit(False) if rule.good is None else share <= rule.good
        bad = F.lit(False) if rule.bad is None else share > rule.bad
        return F.when(good, "+").when(bad, "-").otherwise("0")

    return F.concat(*map(vote, rules))


@dataclass(frozen=True)
class Reliability:
    """The share of good documents, and by rule the chance of each vote (good, bad)."""

    good: float
    given_good: tuple[tuple[float, float], ...]
    given_bad: tuple[tuple[float, float], ...]

    def posterior(self, pattern: str) -> float:
        """Probability of good, given the votes; abstaining says nothing."""
        log = np.log(self.good / (1 - self.good))
        for vote, good, bad in zip(pattern, self.given_good, self.given_bad):
            if vote != "0":
                log += np.log(good["+-".index(vote)] / bad["+-".index(vote)])
        return float(1 / (1 + np.exp(-np.clip(log, -50, 50))))


def estimate(patterns: dict[str, int], rounds: int = 200, prior: float = 0.9) -> Reliability:
    """Expectation-maximisation over the counted patterns of votes.

    A rule's vote is taken for right or wrong independently of the others,
    given the class. The start is a rule that votes bad on half of the bad
    documents and on one good document in twenty; one hundredth of the
    documents' weight stays with it, so no chance becomes zero. A rule is never
    more likely to accuse good documents than bad ones, nor to praise bad ones
    more than good: that fixes which class is which. No pattern at all gives
    the start.
    """
    rules = len(next(iter(patterns), "0" * len(RULES)))
    seen = np.array([["+-0".index(v) for v in p] for p in patterns], int).reshape(-1, rules)
    weight = np.array(list(patterns.values()), float)
    start = np.array([[[0.7, 0.05]] * rules, [[0.3, 0.5]] * rules])
    share, chance, strength = prior, start, 0.01 * weight.sum() + 1
    votes_of = np.stack([seen == v for v in (0, 1)], 2).astype(float)
    for _ in range(rounds):
        log = np.einsum("prv,crv->cp", votes_of, np.log(chance)) + np.log([[share], [1 - share]])
        own = np.exp(log - log.max(0, initial=-np.inf))
        own = own / own.sum(0) * weight
        share = float((own[0].sum() + prior * strength) / (weight.sum() + strength))
        got = np.einsum("cp,prv->crv", own, votes_of) + start * strength
        chance = np.clip(got / (own.sum(1) + strength)[:, None, None], 1e-4, 1 - 1e-4)
        wrong = chance[0] > chance[1]
        wrong[:, 0] = chance[0, :, 0] < chance[1, :, 0]
        even = chance.mean(0)
        chance = np.where(wrong, even, chance)
    return Reliability(share, *(tuple(map(tuple, chance[c].tolist())) for c in (0, 1)))


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rules: Sequence[Rule] = RULES, threshold: float = 0.5,
) -> DataFrame:
    """Counts, votes, posterior and verdict of every document.

    A document fails outright with fewer than 20 words or with over 30 % of its
    words in repeated windows; any other is kept if its posterior probability
    of being good reaches ``threshold``. NULL and empty texts have zero counts
    and fail. Repeated rows are judged alike, each on its own; no other column
    is read; an empty table gives no rows.
    """
    base = stored(counted(docs, id_col, text_col), "quality").withColumn("votes", votes(rules))
    table = posteriors(base.select("votes"))
    return (
        base.join(F.broadcast(table), "votes")
        .withColumn("base_failed", failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def posteriors(cast: DataFrame) -> DataFrame:
    """Each pattern of ``votes`` that was cast, with its ``posterior``: one row per pattern."""
    patterns = {r["votes"]: r["count"] for r in cast.groupBy("votes").count().collect()}
    model = estimate(patterns)
    return cast.sparkSession.createDataFrame(
        [(p, model.posterior(p)) for p in patterns], "votes string, posterior double"
    )


def failed(within: str = "") -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return F.expr(f"{within}n_words < 20 OR 100 * {within}n_repeat_words > 30 * {within}n_words")


def keep_good(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, threshold: float = 0.5,
) -> DataFrame:
    """``docs`` without the rows that ``quality`` rejects; all their columns (of types that Arrow carries).

    Each row is judged by its own text in the task that holds it, so no text is
    shuffled; ids are not read, and rows that share one are judged each for
    itself. Texts are measured twice, once for the estimate.
    """
    key, held = free_name(docs, "_measures"), free_name(docs, "_pattern")
    cast = measured(docs.select(F.col(f"`{text_col}`").alias("text")), key).select(votes(rules, f"{key}.").alias("votes"))
    table = posteriors(cast).select(F.struct("votes", "posterior").alias(held))
    judged = measured(docs, key, text_col).join(
        F.broadcast(table), votes(rules, f"{key}.") == F.col(f"{held}.votes")
    ).filter(~failed(f"{key}.") & (F.col(f"{held}.posterior") >= threshold))
    return judged.select(*(F.col(f"`{c}`") for c in docs.columns))
