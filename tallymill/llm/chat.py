"""Chat formatting over a prefix tree of conversations.

Conversations that begin with the same turns share those turns' nodes. A
node's key is the chain of its turns' digests, so the sorted keys are the tree
depth-first, and a running total over them gives every node its place in one
stream in which shared tokens occur once. Positions count along a node's own
branch. A node sees the stream intervals of its ancestors and, causally,
itself; seen from the other side, it is visible until its subtree ends.

Opening, text and closing of a turn are encoded apart, so that no token crosses
their borders and the loss mask, an interval of a node's tokens, covers exactly
what an assistant says.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.bpe import codec
from tallymill.llm.common import map_batches
from tallymill.operators.ranges import running_total
from tallymill.session import stored

#: A turn is written as opening, role, colon, text, closing. Control strings and
#: backslashes inside role and text get a backslash before them.
OPENING, COLON, CLOSING = "### ", ": ", " </turn>\n"
CONTROL = ("\\", "###", "</turn>")
LOSS_ROLE = "assistant"
PARSED = r"(?s)^### ([^:\\]*+(?:\\.[^:\\]*+)*+): (.*) </turn>\n$"


def escaped(text: Column, control: tuple[str, ...] = CONTROL) -> Column:
    for mark in control:
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\|###|</turn>|:)", "$1")


def turns_of(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, place, node, path, role, segment, lead.

    ``lead`` is the number of characters before the turn's text. Turns stand by ``turn``; ties by role and text, so their order is defined.
    """
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = conversations.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    )
    head = F.concat(F.lit(OPENING), escaped(F.col("role"), (*CONTROL, ":")), F.lit(COLON))
    segment = F.concat("head", escaped(F.col("text")), F.lit(CLOSING))
    keyed = (
        plain.withColumn("place", F.row_number().over(by)).withColumn("head", head)
        .withColumn("segment", segment).withColumn("lead", F.char_length("head"))
        .withColumn("digest", F.substring(F.sha2(F.col("segment").cast("binary"), 256), 1, 32))
        .withColumn("path", F.array_join(F.collect_list("digest").over(upto), ""))
        .withColumn("node", F.sha2(F.col("path").cast("binary"), 256))
    )
    return keyed.select("conv_id", "place", "node", "path", "role", "segment", "lead")


def prefix_tree(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One row per node: its text and tokens once, where they stand, and what they see.

    Columns: node, depth, role, segment, tokens, n_tokens, loss_start, loss_end,
    stream_start, position_start, attend_until, ancestor_intervals. Its tokens
    from ``loss_start`` to before ``loss_end`` are trained on: the text of an
    assistant's turn, none of other turns. Token i of a node has position ``position_start + i``, sees the intervals and the node's tokens
    up to itself, and is seen by stream places before ``attend_until``. What
    lies before a node is the same in all conversations through it; a subtree
    ends where the last conversation through its root does.
    """
    def encode(batch: dict[str, list]) -> dict:
        coder, segments, leads = codec(tokenizer), batch["segment"], batch.pop("lead")
        heads = coder.encode([s[:k] for s, k in zip(segments, leads)])
        texts = coder.encode([s[k:-len(CLOSING)] for s, k in zip(segments, leads)])
        closing = coder.encode([CLOSING])[0]
        spoken = [role == LOSS_ROLE for role in batch["role"]]
        ids = [np.concatenate([h, t, closing]) for h, t in zip(heads, texts)]
        return batch | {
            "tokens": ids, "n_tokens": [len(x) for x in ids],
            "loss_start": [len(h) if yes else 0 for h, yes in zip(heads, spoken)],
            "loss_end": [len(h) + len(t) if yes else 0 for h, t, yes in zip(heads, texts, spoken)],
        }

    distinct = turns.dropDuplicates(["node"]).select("node", "path", "role", "segment", "lead")
    encoded = map_batches(
        distinct, encode,
        "node string, path string, role string, segment string, tokens array<int>, n_tokens long,"
        " loss_start int, loss_end int",
    )
    placed = running_total(encoded, "n_tokens", "stream_end", "path")
    nodes = stored(placed.withColumn("stream_start", F.col("stream_end") - F.col("n_tokens")), "nodes")
    spans = nodes.select("node", "n_tokens", "stream_start", "stream_end")
    path = Window.partitionBy("conv_id")
    before = path.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    walked = turns.select("conv_id", "place", "node").join(spans, "node").select(
        "node", F.col("place").alias("depth"),
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("position_start"),
        F.collect_list(F.struct("stream_start", "stream_end")).over(before).alias("ancestor_intervals"),
        F.max("stream_end").over(path).alias("leaf_end"),
    )
    seen = walked.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("position_start").alias("position_start"),
        F.first("ancestor_intervals").alias("ancestor_intervals"), F.max("leaf_end").alias("attend_until"),
    )
    return nodes.join(seen, "node").select(
        "node", "depth", "role", "segment", "tokens", "n_tokens", "loss_start", "loss_end",
        "stream_start", "position_start", "attend_until", "ancestor_intervals",
    )


def format_conversations(conversations: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """The prefix tree, and which node each turn of each conversation is (conv_id, place, node).

    NULL roles and texts count as empty; rows with a NULL conv_id are one
    conversation. Rows that repeat a turn are turns of their own. Texts of any
    length stay whole; other columns are not read; an empty table gives two
    empty frames. A conversation is one path of the tree, so its turns meet in
    one task, sorted there and spilled if long.
    """
    turns = stored(turns_of(conversations), "turns")
    tree = stored(prefix_tree(turns, tokenizer), "tree")
    return tree, turns.select("conv_id", "place", "node")


def decoded_nodes(tree: DataFrame, tokenizer: str) -> DataFrame:
    """``node``, its text out of its tokens, and the text of the tokens under the loss mask."""
    def decode(batch: dict[str, list]) -> dict:
        coder = codec(tokenizer)
        ids = [np.array(x, np.int64) for x in batch["tokens"]]
        return {
            "node": batch["node"], "written": [coder.decode(x) for x in ids],
            "loss": [coder.decode(x[a:b]) for x, a, b in zip(ids, batch["loss_start"], batch["loss_end"])],
        }

    return map_batches(
        tree.select("node", "tokens", "loss_start", "loss_end"), decode, "node string, written string, loss string"
    )


def read_back(tree: DataFrame, members: DataFrame, tokenizer: str) -> DataFrame:
    """Every conversation's turns, parsed out of the decoded tokens, and the decoded text under the loss mask."""
    text = F.col("written")
    parsed = members.join(decoded_nodes(tree, tokenizer), "node").select(
        "conv_id", "place", F.char_length(text).alias("chars"),
        unescaped(F.regexp_extract(text, PARSED, 1)).alias("role"),
        unescaped(F.regexp_extract(text, PARSED, 2)).alias("text"),
        unescaped(F.col("loss")).alias("loss"),
    )
    whole = parsed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "text", "loss"))).alias("turns"),
        F.count(F.lit(1)).alias("n_turns"), F.sum("chars").alias("formatted_chars"),
    )
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return whole.select(
        "conv_id", "n_turns", F.array_join(turns, "").alias("turns_text"),
        F.array_join(F.col("turns.loss"), "").alias("loss_text"), "formatted_chars",
    )
