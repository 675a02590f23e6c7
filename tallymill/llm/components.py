"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import stored


def _stars(links: DataFrame) -> DataFrame:
    """Every link's larger end tied to the smallest neighbour of its smaller end, and so on.

    The minimum of each node is written before it meets the links again, so
    Spark sees both sides' sizes and can split a node with very many links.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(
        both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-minimum"
    )
    wide = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    wide = stored(wide.filter("a <> b").distinct(), "stars")
    low = wide.groupBy("a").agg(F.min("b").alias("m"))
    near = wide.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stored(
        near.unionByName(low.withColumnRenamed("m", "b")).filter("a <> b").distinct(), "stars"
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one neighbour at most below it, and that one none."""
    ends = F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"))
    ))
    nodes = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return nodes.filter("up > 1 OR up = 1 AND least = 0").isEmpty()


def contracted(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Links (a, b), b < a, that tie the same nodes together: one star per component, unless ``rounds`` end first.

    ``links`` is best a written table, as it is read more than once. Each round
    ties nodes to ever smaller neighbours; the number of rounds grows with the
    logarithm of the longest chain. What comes out can be joined with more
    links and contracted further, which takes fewer rounds than all links anew.
    Only whether the stars are done reaches the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    done = 0
    while rounds is None or done < rounds:
        edges = _stars(edges)
        done += 1
        if rounds is None and _settled(edges):
            break
    return edges


def labels_of(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` of every node that a contracted link ties to a smaller one."""
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (its component's smallest node) of all nodes of links (a, b)."""
    edges = contracted(links)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
