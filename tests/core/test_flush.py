import pytest
from pyspark.sql import functions as F

from quireflow.sources import metric_sink
from quireflow.sources.metric_sink import MetricSink
from quireflow.streaming.flush import flush_counted, flush_table

KIND = "run string, place bigint, value double"


def images(spark, path, sizes, every):
    """Writes files of these sizes, dealt to two runs; returns what each flush holds."""
    want, held, place = {}, {"a": (0, 0.0), "b": (0, 0.0)}, 0
    for size in sizes:
        rows = []
        for _ in range(size):
            run = "a" if place % 3 else "b"
            rows.append((run, place, float(place) if place % 5 else None))
            n, total = held[run]
            n, total = n + 1, total + (rows[-1][2] or 0.0)
            held[run] = n, total
            want[run, (n - 1) // every] = (n, total, n % every == 0)
            place += 1
        spark.createDataFrame(rows[::-1], KIND).coalesce(1).write.mode("append").parquet(path)
    return want


def stream(spark, path):
    return spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("every", [1, 4, 100])
def test_flushes_do_not_follow_files(spark, tmp_path, every):
    want = images(spark, f"{tmp_path}/in", [5, 1, 9, 3], every)
    sink = MetricSink(spark, f"{tmp_path}/out", "r")
    flush_counted(spark, stream(spark, f"{tmp_path}/in"), every, sink, f"{tmp_path}/state").awaitTermination()
    assert sink.commits() == [0, 1, 2, 3]
    assert {(r.run, r.flush): (r.images, r.total, r.done) for r in flush_table(sink).collect()} == want


def test_state_survives_a_restart_and_a_lost_commit(spark, tmp_path, monkeypatch):
    want = images(spark, f"{tmp_path}/in", [5, 4, 7], 4)
    sink = MetricSink(spark, f"{tmp_path}/out", "r")
    real, calls = MetricSink._publish, []

    def breaks(self, batch, folders):
        calls.append(batch)
        if calls.count(1) == 1 and batch == 1:
            raise OSError("lost before the commit")
        return real(self, batch, folders)

    monkeypatch.setattr(metric_sink.MetricSink, "_publish", breaks)
    with pytest.raises(Exception, match="lost before the commit"):
        flush_counted(spark, stream(spark, f"{tmp_path}/in"), 4, sink, f"{tmp_path}/state").awaitTermination()
    assert sink.commits() == [0]  # what batch 1 wrote is not seen
    before = flush_table(sink).count()
    flush_counted(spark, stream(spark, f"{tmp_path}/in"), 4, sink, f"{tmp_path}/state").awaitTermination()
    assert sink.commits() == [0, 1, 2] and before < len(want)
    assert {(r.run, r.flush): (r.images, r.total, r.done) for r in flush_table(sink).collect()} == want


def test_a_batch_is_committed_once(spark, tmp_path):
    sink = MetricSink(spark, f"{tmp_path}/m", "r1")
    assert sink.rows("text") is None and sink.newest("text") is None and sink.commits() == []
    one, two = (spark.createDataFrame([(v,)], "v int") for v in (1, 2))
    assert sink.commit(0, {"text": one, "tags": two}) and not sink.commit(0, {"text": two})
    assert sink.commit(1, {"text": two})
    assert sorted((r.v, r.run_id) for r in sink.rows("text").collect()) == [(1, "r1"), (2, "r1")]
    assert [r.v for r in sink.newest("text").collect()] == [2] and sink.newest("tags") is None
    other = MetricSink(spark, f"{tmp_path}/m", "r2")
    assert other.commit(0, {"text": two.where(F.lit(False))}) and other.rows("text").collect() == []
    sink.reset()
    assert sink.commits() == [] and other.commits() == [0]
