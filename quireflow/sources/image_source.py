"""A Python data source that lists a folder of images: sorted by name, cut to a limit, numbered; no file is opened."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quireflow.config import IMAGE_NAME

SCHEMA = "image_name string, path string, image_index bigint, length bigint"
#: Files that one partition lists.
FILES = 1000


def listed_files(path: str) -> list[tuple[str, str, int]]:
    """(name, path, length) of the files in a folder, not below it, by name. Names that begin with a point or an underscore are left out, as Spark's sources do."""
    local = "://" not in path
    fs, base = pafs.FileSystem.from_uri(f"file://{os.path.abspath(path.removeprefix('file:'))}" if local else path)
    root = "file://" if local or path.startswith("file://") else "/".join(path.split("/")[:3]).rstrip("/")
    found = fs.get_file_info(pafs.FileSelector(base, recursive=False))
    rows = [(i.base_name, i.path, i.size) for i in found if i.type == pafs.FileType.File and i.base_name[0] not in "._"]
    return sorted((n, f"{root}/{p.lstrip('/')}", s) for n, p, s in rows)


@dataclass
class Files(InputPartition):
    """What one partition lists."""

    rows: list[tuple]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.most, self.each = options["path"], int(options.get("maximages", 0)), int(options.get("filesperpartition", FILES))

    def partitions(self) -> list[InputPartition]:
        """The listing is made here, once: the limit counts every file, then only images stay, with their number among all."""
        every = listed_files(self.path)
        rows = [(n, p, i, s) for i, (n, p, s) in enumerate(every[: self.most] if self.most > 0 else every) if re.search(IMAGE_NAME, n.lower())]
        return [Files(rows[i : i + self.each]) for i in range(0, len(rows), self.each)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        yield from partition.rows


class ImageFolder(DataSource):
    """spark.read.format("image_folder").option("maxImages", n).load(folder); n of 0 or less is no limit."""

    @classmethod
    def name(cls) -> str:
        return "image_folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def image_folder(spark: SparkSession, path: str, most: int = 0) -> DataFrame:
    """(image_name, path, image_index, length) of a folder's images, in order."""
    spark.dataSource.register(ImageFolder)
    return spark.read.format("image_folder").option("maxImages", most).load(path)
