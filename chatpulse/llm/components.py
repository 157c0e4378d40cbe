"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatpulse.llm.common import frozen


def _hang(links: DataFrame) -> DataFrame:
    """Hangs every node's larger neighbours on the smallest node beside it."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.join(least, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .distinct()
    )


def _gather(links: DataFrame) -> DataFrame:
    """Hangs every node and its smaller neighbours on the smallest of those."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    others = links.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).union(others).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (bigint); the root is the smallest.

    Alternates the two star steps until nothing moves, which takes a number of
    rounds that grows with the logarithm of the longest chain. Links are counted
    and hashed in Spark; only those two numbers reach the driver.
    """
    stars = frozen(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        stars = frozen(_gather(_hang(stars)), "links")
        state = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
    roots = stars.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
