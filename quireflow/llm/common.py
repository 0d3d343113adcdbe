"""Shared plumbing of the training-data operators: tables, scratch storage, Arrow helpers, ASCII word bytes."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

#: Contract classes over UTF-8 bytes: every byte above 0x7F belongs to a non-ASCII character.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ALNUM = bytes(
    (b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores added while the input has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lowered_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at space and 0x09-0x0D; null gives no words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased runs of digits, letters and non-ASCII characters; null gives no words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_ALNUM).split()


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; one of our own only on a single machine whose session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder; a machine's own one would lose data on a cluster")
        base = "file:///tmp/checkpoints/quireflow"
    return f"{base.rstrip('/')}/quireflow-{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_kept: dict[str, SparkSession] = {}


def _clean() -> None:
    for path, spark in list(_kept.items()):
        try:
            remove(spark, path)
        except Exception:  # the JVM may be gone at exit
            return


atexit.register(_clean)


class Stored:
    """A DataFrame written once to shared storage: lineage ends here, so lost executors cost no recomputation."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        _kept[self.path] = self.spark
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def n_bytes(self) -> int:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()

    def drop(self) -> None:
        _kept.pop(self.path, None)
        remove(self.spark, self.path)


def free(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of DataFrames that are no longer referred to; it notices by garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    return Stored(df, name).df


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that one column holds about most_bytes a slice (a longer single value stays whole)."""
    for batch in batches:
        n = batch.num_rows
        col = batch.column(column)
        if not n:
            continue
        if col.nbytes <= most_bytes:
            yield batch
            continue
        at, size = 0, 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        for i, s in enumerate(sizes):
            if size and size + s > most_bytes:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += s
        yield batch.slice(at)
