"""Exact duplicates: the frequent texts apart from all others.

A Misra-Gries summary (``DataFrame.stat.freqItems``) holds every digest that
more than one row in ``counters`` has. Its candidates are counted over all
rows; those that are truly that frequent, the winners, are few by definition
and are broadcast, so rows of the largest groups are settled where they are
read. All other groups are small against the table and take the ordinary
shuffle, on digests only, never on texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import free_name
from tallymill.session import stored

#: ``freqItems`` takes no support under 1e-4.
LEAST_COUNTERS, MOST_COUNTERS = 1024, 10_000


def counters_for(df: DataFrame) -> int:
    """Enough that a group too small to be a winner is less than a shuffle partition's share.

    The bound keeps the broadcast winners below 10 MB.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_COUNTERS, max(LEAST_COUNTERS, 4 * partitions))


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct (id, text): ``doc_id``, ``text_sha256``, ``copies``."""
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"), text_digest(F.col(f"`{text_col}`")).alias("text_sha256")
    ).groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))


def frequent(table: DataFrame, counters: int) -> DataFrame:
    """Digests of more than one ``counters``-th of the rows, with their group: at most ``counters`` rows."""
    found = table.stat.freqItems(["text_sha256"], 1.0 / counters)
    candidates = found.select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    exact = by_text(table.join(F.broadcast(candidates), "text_sha256"))
    rows = table.agg(F.count(F.lit(1)).alias("_rows"))
    return exact.join(F.broadcast(rows), F.col("group_rows") * counters > F.col("_rows")).drop("_rows")


def by_text(table: DataFrame) -> DataFrame:
    return table.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"),
        F.count(F.lit(1)).alias("group_rows"),
    )


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None
) -> DataFrame:
    """Every document with the group of its text, dropped ones too.

    Returns doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the
    largest id stays. NULL texts count as empty and form one group with empty
    ones. A NULL id is smaller than any other; a group of NULL ids alone keeps
    its NULL. Rows that repeat both id and text are one document, which counts
    as often in ``group_size`` as it comes. Other columns are not read; an
    empty table gives no rows.
    """
    table = stored(digests(df, id_col, text_col), "digests")
    winners = stored(frequent(table, counters or counters_for(df)), "winners")
    settled = table.join(F.broadcast(winners), "text_sha256")
    rest = table.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    shuffled = rest.join(by_text(rest), "text_sha256")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return settled.unionByName(shuffled).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
    ).select(columns)


def drop_exact_copies(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None
) -> DataFrame:
    """``df`` with one row of each text, all its columns and no others.

    The rules are those of ``exact_groups``. Only the ids to be dropped meet
    the texts, as the built side of a hash join. Rows that repeat both id and
    text all stay: nothing tells them apart.
    """
    key, digest = free_name(df, "_drop_id"), free_name(df, "_drop_digest")
    dropped = exact_groups(df, id_col, text_col, counters).filter("NOT kept").select(
        F.col("doc_id").alias(key), F.col("text_sha256").alias(digest)
    )
    match = F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (
        text_digest(F.col(f"`{text_col}`")) == F.col(digest)
    )
    return df.join(dropped.hint("shuffle_hash"), match, "left_anti")


EXACT_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
