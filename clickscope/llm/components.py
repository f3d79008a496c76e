"""Connected components of an edge table by alternating large and small stars.

Each round every node links its larger neighbours, then its smaller ones, to
the smallest node it knows, until only stars are left; the number of rounds
grows with the logarithm of the longest chain.  No neighbour list is gathered:
a round is a ``min`` per node (combined before the shuffle) and a join with it,
which splits a node with very many links.  Each round is checkpointed in the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.session import work_dir


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns of one type) that is
    not itself the smallest of its component; self-links and repeats are fine."""
    work_dir(edges.sparkSession)
    u, v = edges.columns
    e = (edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b"))
         .where("a != b").distinct().checkpoint())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).checkpoint()
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct().checkpoint()
        least = large.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
        small = (large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        e = small.distinct().checkpoint()
        before, state = state, _state(e)
        if before == state:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
