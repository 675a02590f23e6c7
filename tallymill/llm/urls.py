"""URL filtering: listed rules first, then words inside host names.

Host names glue words together. A unigram model of the pages' own words splits
each label into its most probable words (Viterbi); multinomial naive Bayes
then scores the words of host and path. It learns from all urls: those that
show an unwanted word standing by itself are bad examples, the others good. The
counts of both models stay in tables and are joined to what needs them, so
none is left out, however many there are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import map_batches
from tallymill.session import stored

#: verdict, host, path
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Words that mark a bad example, fixed values.
UNWANTED = frozenset("adult bet bets betting casino gambling malware phishing poker porn sex spam viagra xxx".split())
LONGEST_WORD = 24
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
PLAIN = re.compile(r"[a-z]+|[0-9]+")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(LOWER), tail[:stop]


class Rules:
    """Rules by host; a rule holds for the host, its subdomains and paths that begin alike."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((verdict, host, path))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and its verdict; of equal ones the first listed."""
        best: tuple[str | None, str | None] = (None, None)
        labels = host.split(".")
        for i in range(len(labels)):
            for verdict, own, start in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(start) and len(own + start) > len(best[0] or ""):
                    best = (own + start, verdict)
        return best


class Splitter:
    """The most probable words of a string of letters under unigram counts.

    An unknown word of n letters counts as if seen 10**-n times.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = math.log(max(1, sum(counts.values()) if total is None else total))
        self.log = {w: math.log(c) - self.total for w, c in counts.items()}
        self.known: dict[str, tuple[str, ...]] = {}

    def words(self, label: str) -> tuple[str, ...]:
        if label not in self.known:
            if len(self.known) >= 100_000:
                self.known.clear()
            self.known[label] = self._words(label)
        return self.known[label]

    def _words(self, label: str) -> tuple[str, ...]:
        score, back = [0.0], [0]
        for end in range(1, len(label) + 1):
            best = max(
                (score[start] + self._value(label[start:end]), start)
                for start in range(max(0, end - LONGEST_WORD), end)
            )
            score.append(best[0])
            back.append(best[1])
        out, end = [], len(label)
        while end:
            out.append(label[back[end]:end])
            end = back[end]
        return tuple(out[::-1])

    def _value(self, word: str) -> float:
        known = self.log.get(word)
        return -self.total - 2.3 * len(word) if known is None else known


def plain_tokens(host: str, path: str) -> list[str]:
    """Runs of letters or digits of the host (without its last label) and the path."""
    name = host.rpartition(".")[0]
    return PLAIN.findall(name) + PLAIN.findall(path.translate(LOWER))


def word_counts(pages: DataFrame) -> DataFrame:
    """``word`` and ``count`` over all pages' text and urls.

    A word seen once, and that in a url, is left out: it may be the very name to be split.
    """
    visible = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    address = F.regexp_replace(F.coalesce("url", F.lit("")), r"[?#].*|^.*?://", "")
    words = lambda text: F.transform(
        F.split(F.lower(text), "[^a-z]+"), lambda w: F.struct(w.alias("word"), F.lit(text is visible).alias("shown"))
    )
    every = pages.select(F.inline(F.concat(words(visible), words(address))))
    counted = every.filter(F.length("word").between(2, LONGEST_WORD)).groupBy("word").agg(
        F.count(F.lit(1)).alias("count"), F.max("shown").alias("shown")
    )
    return counted.filter("count > 1 OR shown").select("word", "count")


def split_runs(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``run`` and its most probable ``words``; each run meets the counts of its own parts only."""
    total = counts.agg(F.sum("count")).first()[0] or 0

    def parts(batch: dict[str, list]) -> dict:
        out: dict[str, list] = {"run": [], "word": []}
        for run in batch["run"]:
            own = {run[i:j] for i in range(len(run)) for j in range(i + 1, min(len(run), i + LONGEST_WORD) + 1)}
            out["run"] += [run] * len(own)
            out["word"] += own
        return out

    def work(batch: dict[str, list]) -> dict:
        known = [{k["word"]: k["count"] for k in row} for row in batch["known"]]
        return {"run": batch["run"], "words": [
            ["0"] if run[0].isdigit() else list(Splitter(own, total).words(run)) for run, own in zip(batch["run"], known)
        ]}

    letters = map_batches(runs.filter("run RLIKE '^[a-z]'"), parts, "run string, word string")
    known = letters.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("word", "count")).alias("known"))
    none = F.expr("CAST(array() AS array<struct<word:string,count:bigint>>)")
    rows = runs.join(known, "run", "left").select("run", F.coalesce("known", none).alias("known"))
    return map_batches(rows, work, "run string, words array<string>")


def token_odds(tokens: DataFrame, urls: DataFrame) -> tuple[DataFrame, float]:
    """``token`` and its log odds of bad, add-one smoothed, over all urls as often as they occur; and the prior."""
    of = lambda bad: F.coalesce(F.sum(F.when(F.col("bad") == bad, F.col("times"))), F.lit(0))
    counted = stored(tokens.groupBy("token").agg(of(True).alias("t"), of(False).alias("f")), "token-counts")
    whole = counted.agg(F.sum("t"), F.sum("f"), F.count(F.lit(1))).first()
    bad, good, size = (whole[0] or 0), (whole[1] or 0), whole[2] + 1
    pages = urls.agg(of(True), of(False)).first()
    share = lambda n, total: F.log((F.col(n) + 1) / F.lit(float(total + size)))
    odds = counted.select("token", (share("t", bad) - share("f", good)).alias("odds"))
    return odds, math.log((pages[0] + 1) / (pages[1] + 1))


def _in_order(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v["odds"])


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
    threshold: float = 0.5,
) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_score and host_words of every page.

    Needs ``url`` and ``html``. The longest fitting rule decides; without one a
    url is blocked if its probability of being bad reaches ``threshold``. A
    NULL url or one without ``://`` has an empty host and path, no rule, and
    the score of an empty bag. NULL html has no words. Repeated rows are judged
    alike; other columns are not read; an empty table gives no rows.
    """
    listed = Rules(rules)

    def read(batch: dict[str, list]) -> dict:
        names = ("url", "times", "host", "path", "rule", "listed", "bad", "runs")
        out: dict[str, list] = {name: [] for name in names}
        for url, times in zip(batch["url"], batch["times"]):
            host, path = split_url(url)
            rule, verdict = listed.find(host, path)
            bad = not UNWANTED.isdisjoint(plain_tokens(host, path))
            runs = [
                {"mark": mark, "run": run} for mark, text in (("h:", host.rpartition(".")[0]), ("p:", path.translate(LOWER)))
                for run in PLAIN.findall(text)
            ]
            for name, value in zip(names, (url, times, host, path, rule, verdict, bad, runs)):
                out[name].append(value)
        return out

    own = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), "url")
    urls = stored(map_batches(
        own.groupBy("url").agg(F.count(F.lit(1)).alias("times")), read,
        "url string, times long, host string, path string, rule string, listed string, bad boolean, "
        "runs array<struct<mark:string,run:string>>",
    ), "urls")
    runs = urls.select("url", "times", "bad", F.posexplode("runs").alias("place", "r")).select(
        "url", "times", "bad", "place", "r.mark", "r.run"
    )
    splits = split_runs(runs.select("run").distinct(), stored(word_counts(pages), "word-counts"))
    tokens = stored(
        runs.join(stored(splits, "splits"), "run")
        .select("url", "times", "bad", "place", "mark", F.posexplode("words").alias("part", "word"))
        .withColumn("token", F.concat("mark", "word")), "tokens",
    )
    odds, prior = token_odds(tokens, urls)
    bags = tokens.join(odds, "token").groupBy("url").agg(
        F.array_sort(F.collect_list(F.struct("place", "part", "mark", "word", "odds"))).alias("bag")
    ).withColumnRenamed("url", "_url")
    empty = F.expr("CAST(array() AS array<string>)")
    hosts = F.transform(F.filter("bag", lambda t: t["mark"] == "h:"), lambda t: t["word"])
    total = F.lit(prior) + F.coalesce(_in_order(F.col("bag")), F.lit(0.0))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), total))))
    judged = urls.join(bags, F.col("url") == F.col("_url"), "left").select(
        F.col("url").alias("_url"), "host", "path", "rule", score.alias("bad_score"),
        F.coalesce("listed", F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
        F.array_join(F.coalesce(hosts, empty), " ").alias("host_words"),
    )
    return own.join(stored(judged, "judged"), F.col("url").eqNullSafe(F.col("_url"))).select(
        "page_id", "host", "path", "rule", "verdict", "bad_score", "host_words"
    )
