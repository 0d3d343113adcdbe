"""Metrics that are flushed whenever a run has seen so many more images, as a Structured Streaming job with state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quireflow.sources.metric_sink import MetricSink

#: What the state store has to be.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
FLUSH = "run string, flush bigint, images bigint, total double, done boolean"


class CountedFlush(StatefulProcessor):
    """State of a run: images seen and the sum of their values. Rows of a batch are taken in their order.

    Every ``every`` images, wherever files or batches end, a flush is given out with all that the run holds up to there; at the
    batch's end so is the flush that is still open, with done false, to be replaced by what later batches say of it.
    """

    def __init__(self, every: int):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", "images bigint, total double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        images, total = self._held.get() if self._held.exists() else (0, 0.0)
        ordered = sorted(((r["place"], r["value"]) for r in rows))
        for _, value in ordered:
            images, total = images + 1, total + (value or 0.0)
            if images % self.every == 0:
                yield Row(run=key[0], flush=images // self.every - 1, images=images, total=total, done=True)
        self._held.update((images, total))
        if images % self.every:
            yield Row(run=key[0], flush=images // self.every, images=images, total=total, done=False)

    def close(self) -> None:
        pass


def counted_flushes(images: DataFrame, every: int) -> DataFrame:
    """(run, flush, images, total, done) of a stream of images (run, place, value); place orders them in a run."""
    for name, value in STATE_STORE.items():
        images.sparkSession.conf.set(name, value)
    return images.select("run", "place", "value").groupBy("run").transformWithState(CountedFlush(every), FLUSH, "Append", "None")


def flush_counted(spark: SparkSession, images: DataFrame, every: int, sink: MetricSink, checkpoint: str) -> StreamingQuery:
    """Runs a stream of images over all there are; each batch's flushes are committed once under its number.

    State survives restarts through the checkpoint, and a batch that is repeated after a failure finds its commit.
    """
    return (
        counted_flushes(images, every).writeStream.outputMode("append").foreachBatch(lambda batch, number: sink.commit(number, {"flushes": batch.withColumn("batch", F.lit(number).cast("long"))}) and None)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def flush_table(sink: MetricSink) -> DataFrame | None:
    """(run, flush, images, total, done): each flush as the last batch that spoke of it has it; None before the first batch."""
    rows = sink.rows("flushes")
    if rows is None:
        return None
    values = F.struct("images", "total", "done")
    return rows.groupBy("run", "flush").agg(F.max_by(values, "batch").alias("v")).select("run", "flush", "v.*")


def flush_metrics(spark: SparkSession, source: str, schema, files_per_batch: int, sink: str, checkpoint: str, key: str, value: str, names: str = "*.parquet") -> StreamingQuery:
    """Every `files_per_batch` new files, the cumulative (key, n, total) of all files so far replaces the sink's table.

    For triggers by files; flush_counted counts images, and its sink is never seen half replaced.
    """
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", names).parquet(source)
    totals = files.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(sink)

    return totals.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
