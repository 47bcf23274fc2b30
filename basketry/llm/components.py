"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.session import materialise


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of a link; ``root`` is the least node it reaches.

    Each round hangs the greater neighbours of a node on its least neighbour (large star), then
    the lesser ones (small star), until nothing changes; the rounds grow with the logarithm of
    the longest path.  Least neighbours are partial aggregates and the joins are ordinary ones,
    so a node with very many links is neither gathered nor kept in one task.  Rounds are cut by
    a table in the shared folder.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    links = links.where("a <> b and a is not null and b is not null")
    now = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "links")
    before, state = None, _fingerprint(now)
    while state != before:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a")
        small = (met.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                              F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                            .alias("l")).select("l.a", "l.b").where("a <> b").distinct())
        now = materialise(small, "links")
        before, state = state, _fingerprint(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
