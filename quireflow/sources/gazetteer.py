"""Gazetteers: a table, or a service asked over HTTP."""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def looked_up(name: str, url: str, user: str, fuzzy: float = 0.8, timeout: float = 60.0) -> list[int]:
    """Ids in the service's order; none if it answers with an HTTP error. Other errors are raised."""
    query = urllib.parse.urlencode({"q": name, "fuzzy": fuzzy, "username": user})
    try:
        with urllib.request.urlopen(f"{url}?{query}", timeout=timeout) as answer:
            return [g["geonameId"] for g in json.load(answer).get("geonames", [])]
    except urllib.error.HTTPError:
        return []


def service_gazetteer(names: DataFrame, url: str, user: str, column: str = "text", fuzzy: float = 0.8) -> DataFrame:
    """(name, rank, geoname_id) of the distinct names that the service knows; each name is asked once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, i, g) for n in batch.column("name").to_pylist() for i, g in enumerate(looked_up(n, url, user, fuzzy))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64()), strict=True)], ["name", "rank", "geoname_id"])

    distinct = names.where(F.col(column).isNotNull()).select(F.col(column).alias("name")).distinct()
    return distinct.mapInArrow(run, "name string, rank int, geoname_id bigint")
