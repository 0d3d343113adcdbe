"""Metric tables that a run adds to batch by batch, each batch once.

A batch is written below a folder of its own name and of no meaning yet. Then one small file, the batch's commit, names
those folders; it is put in place whole, by a move. Readers go by commits alone, so a batch that was interrupted is not
there, one that is repeated is not written again, and a table is never seen half replaced. A run's newest commit is its
pointer: cumulative tables are read at it, tables of single rows up to it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MetricSink:
    """The tables of one run below <path>/<run id>; works on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.base = f"{path.rstrip('/')}/{run_id}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def reset(self) -> None:
        """A run begins anew: what it committed before goes, and what it wrote with it. Commits go first."""
        for part in ("commits", "data"):
            self._fs.delete(self._path(f"{self.base}/{part}"), True)

    def commits(self) -> list[int]:
        """Numbers of the batches that are there, in order."""
        at = self._path(f"{self.base}/commits")
        found = self._fs.listStatus(at) if self._fs.exists(at) else []
        return sorted(int(s.getPath().getName()[:-5]) for s in found if s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith("."))

    def _told(self, batch: int) -> dict[str, str]:
        return json.loads(self.spark.sparkContext.wholeTextFiles(f"{self.base}/commits/{batch:012d}.json").first()[1])

    def commit(self, batch: int, tables: dict[str, DataFrame]) -> bool:
        """Writes a batch's tables and commits them together; False, and nothing is computed, if the batch is there."""
        if self._fs.exists(self._path(f"{self.base}/commits/{batch:012d}.json")):
            return False
        folders = {name: f"data/{name}/{batch:012d}-{uuid.uuid4().hex}" for name in tables}
        for name, rows in tables.items():
            rows.write.parquet(f"{self.base}/{folders[name]}")
        return self._publish(batch, folders)

    def _publish(self, batch: int, folders: dict[str, str]) -> bool:
        own, last = (self._path(f"{self.base}/commits/{n}") for n in (f".{uuid.uuid4().hex}", f"{batch:012d}.json"))
        with_text = self._fs.create(own)
        with_text.write(bytearray(json.dumps(folders).encode()))
        with_text.close()
        return bool(self._fs.rename(own, last))

    def _read(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        rows = self.spark.read.schema(self.spark.read.parquet(f"{self.base}/{folders[0]}").schema).parquet(*[f"{self.base}/{f}" for f in folders])
        return rows.withColumn("run_id", F.lit(self.run_id))

    def rows(self, name: str) -> DataFrame | None:
        """A table's rows of all batches; None before the first."""
        return self._read([t[name] for b in self.commits() if name in (t := self._told(b))])

    def newest(self, name: str) -> DataFrame | None:
        """A table as its last batch has it; None before the first."""
        told = [t[name] for b in self.commits()[-1:] if name in (t := self._told(b))]
        return self._read(told)
