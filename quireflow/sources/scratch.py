"""Intermediate tables in the folder that a cluster shares: written once, read again, removed when they are done with."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quireflow.sources.tables import shared_folder


class Scratch:
    """A DataFrame written as Parquet; lineage ends here, so a lost executor costs no recomputation of what came before.

    counted: aggregates, by name, that are observed in the pass that writes (no job of their own); see ``counts``.
    """

    def __init__(self, df: DataFrame, name: str, **counted):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/quireflow-{name}-{uuid.uuid4().hex}"
        watch = Observation(name) if counted else None
        seen = df.observe(watch, *[c.alias(n) for n, c in counted.items()]) if watch else df
        seen.write.parquet(self.path)
        self.counts: dict = watch.get if watch else {}
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def counting(condition: Column) -> Column:
    """An aggregate for ``counted``: how many rows meet a condition (0 in an empty table)."""
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))
