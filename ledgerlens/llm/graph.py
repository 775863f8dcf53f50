"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import scratch_root


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge to another: the least node it is
    connected with.  ``edges`` has columns a and b of one orderable type; loops,
    repeats and nulls are allowed and mean nothing.

    Alternating stars: every node points its larger neighbours to its least one,
    then its smaller ones, until nothing changes.  The rounds are logarithmic in
    the longest path, each is a join and an aggregation, and each is checkpointed.
    """
    scratch_root(edges.sparkSession)
    own = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
           .distinct().checkpoint())
    before = None
    while True:
        state = own.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        both = own.unionByName(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        own = small.distinct().checkpoint()
    return own.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        own.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
