"""What runs leave behind, read again: recognition JSON and event files of metrics."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_READ = "image_index int, regions array<struct<bbox:array<int>,text:string>>"


def read_recognition(spark: SparkSession, path: str) -> DataFrame:
    """(image_name, image_index, regions) of every .json file below a path that names an image_index; image_name is the file's name up to its first point."""
    raw = spark.read.schema(_READ).options(multiLine=True, pathGlobFilter="*.json", recursiveFileLookup=True).json(path)
    return raw.select(F.substring_index("_metadata.file_name", ".", 1).alias("image_name"), "image_index", "regions").where(F.col("image_index").isNotNull())


def recognition_of(readings: DataFrame, image_name: str) -> DataFrame:
    """One image's recognition."""
    return readings.where(F.col("image_name") == image_name)


def index_names(readings: DataFrame) -> Column:
    """Aggregate: a map from image index to image name; of several names the largest counts."""
    return F.map_from_entries(F.array_agg(F.struct("image_index", "image_name")))


def index_table(readings: DataFrame) -> DataFrame:
    """(image_index, image_name), one row per index."""
    return readings.groupBy("image_index").agg(F.max("image_name").alias("image_name"))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: integers as such, all others as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def records(data: bytes) -> Iterator[bytes]:
    """Payloads of a record file (length, its sum, payload, its sum); a record cut off at the end is left out."""
    at = 0
    while at + 12 <= len(data):
        (size,) = struct.unpack_from("<Q", data, at)
        if at + 16 + size > len(data):
            return
        yield data[at + 12 : at + 12 + size]
        at += 16 + size


def scalars(data: bytes) -> Iterator[tuple[float, str, int, float]]:
    """(wall_time, name, step, value): the first summary value of each event that has one."""
    for record in records(data):
        event = dict(_fields(record))
        values = [v for number, v in _fields(event.get(5, b"")) if number == 1]
        if values:
            first = dict(_fields(values[0]))
            value = struct.unpack("<f", first[2])[0] if 2 in first else 0.0
            yield struct.unpack("<d", event[1])[0] if 1 in event else 0.0, first.get(1, b"").decode(), event.get(2, 0), value


def read_events(spark: SparkSession, path: str, contains: str = "events.out.tfevents") -> DataFrame:
    """(file, seq, wall_time, name, step, value) of all event files below a path; seq is a row's place in its file."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=f"*{contains}*").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = [(file, i, *r) for i, r in enumerate(scalars(data))]
                if rows:
                    kinds = [pa.string(), pa.int32(), pa.float64(), pa.string(), pa.int64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "seq", "wall_time", "name", "step", "value"])

    return files.mapInArrow(run, "file string, seq int, wall_time double, name string, step bigint, value double")
