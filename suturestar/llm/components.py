"""Connected components of a graph given by edges, as joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suturestar.llm.frames import discard, kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours below its smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours below the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node that is not the smallest of its component; root is the smallest.

    Edges are long columns `u`, `v` in any direction; loops and repeated edges are allowed.  Rounds alternate the
    two star operations until nothing changes, which takes few rounds (logarithmic in a component's diameter); each
    round is written down, so a lost executor costs one round at most.
    """
    tidy = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, seen = kept(tidy, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, last = state, now
        now = kept(_small_star(_large_star(last)).distinct(), "edges")
        discard(last)
