"""Connected components of a table of links, by contracting stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.session import stage


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a long, b long)``: the smallest node it reaches.

    Large stars and small stars in turn until nothing changes, so the number of rounds grows with
    the logarithm of the longest chain. Each round is written to the shared folder; only a count and
    a checksum of the links come to the driver. Loops and repeated links do no harm.
    """
    now = stage(_ordered(links.select("a", "b")), "links")
    state = None
    while (seen := _state(now)) != state:
        state = seen
        large = stage(_large_star(now), "links")
        now = stage(_small_star(large), "links")
    # What is left are stars: every node links straight to its root.
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.union(now.select(F.col("b"), F.col("b"))).distinct()


def _ordered(links: DataFrame) -> DataFrame:
    """The larger node first, each link once."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return _ordered(
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    turned = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(turned.union(least.select("a", F.col("m").alias("b"))))
