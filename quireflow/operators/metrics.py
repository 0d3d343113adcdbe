"""Metric tables: pivots, coverage, histograms, last rows, cumulative flushes and run comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pivoted(events: DataFrame, index: str, name: str, value: str, names: list[str]) -> DataFrame:
    """A row per index with the mean value of each name. Names are given, so no pass is spent on finding them."""
    return events.groupBy(index).pivot(name, names).agg(F.avg(value))


def coverage(metrics: DataFrame, column: str) -> DataFrame:
    """Rows, rows with a value, and their ratio."""
    return metrics.agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("n_valid")).select("n", "n_valid", F.try_divide(F.col("n_valid").cast("double"), F.col("n")).alias("coverage"))


def histogram(metrics: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, n) over equal bins from minimum to maximum; the last bin is closed. The bounds are a one-row aggregate."""
    known = metrics.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    bounded = known.join(F.broadcast(known.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))))
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")) * bins), F.lit(0))
    return bounded.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def last_rows(metrics: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key."""
    values = F.struct(*[c for c in metrics.columns if c != key])
    return metrics.groupBy(key).agg(F.max_by(values, F.struct(*order)).alias("r")).select(key, "r.*")


#: Batches that one task adds up.
BLOCK = 4096


def cumulative_flushes(metrics: DataFrame, index: str, every: int, value: str) -> DataFrame:
    """(batch, n, total): what a table holds after each flush of `every` images.

    Rows are summed per batch, batches run on within blocks of BLOCK, and each block is lifted by the sum of the blocks
    before it; only that last sum, a row per block, is made in one task.
    """
    per = metrics.groupBy(F.floor(F.col(index) / every).alias("batch")).agg(F.count(F.lit(1)).alias("b_n"), F.sum(value).alias("b_total")).withColumn("block", F.floor(F.col("batch") / BLOCK))
    blocks = per.groupBy("block").agg(F.sum("b_n").alias("n"), F.sum("b_total").alias("total"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("total_before"))
    so_far = Window.partitionBy("block").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    inside = per.select("block", "batch", F.sum("b_n").over(so_far).alias("n"), F.sum("b_total").over(so_far).alias("total"))
    return inside.join(before, "block").select("batch", (F.col("n") + F.col("n_before")).alias("n"), (F.col("total") + F.col("total_before")).alias("total"))


def compared_runs(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """Both runs' values side by side, with their difference."""
    one, two = (df.select(*key, F.col(value).alias(n)) for df, n in ((a, "value_a"), (b, "value_b")))
    return one.join(two, key, "full").withColumn("difference", F.col("value_b") - F.col("value_a"))
