"""Connected components by alternating large and small stars, in DataFrame operations only.

Each round moves every link towards its neighbourhood's smallest node; a logarithmic number of rounds leaves stars.
Rounds are written to shared storage, so nothing is recomputed after a loss and plans stay short. Joins on a node
are salted by the other end, so a hub with a large share of all links is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored

SALTS = 4


def _with_smallest(links: DataFrame, smallest: DataFrame) -> DataFrame:
    """links (u, v) with m, the value of u in smallest (u, m)."""
    salted = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"]).drop("salt")


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = _with_smallest(both.where("v > u"), near).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    below = large.groupBy("u").agg(F.min("v").alias("m"))
    small = _with_smallest(large, below).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(below.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str | Column, b: str | Column, rounds: int | None = None) -> DataFrame:
    """(node, root) for each node that has a link and is not its component's smallest node.

    rounds: stop after so many; a root is then some node of the component, and a component may have several.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    now = Stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links")
    state = _state(now.df)
    done = 0
    while state[0] and done != rounds:
        done += 1
        new = Stored(_round(now.df), "links")
        now.drop()
        now, before, state = new, state, _state(new.df)
        if state == before:
            break
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
