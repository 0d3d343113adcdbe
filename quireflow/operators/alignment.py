"""Two readings of the same region side by side: the edits that make one the other, and which characters are taken for which."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of a table of distances that is kept whole; larger ones are halved.
CELLS = 1 << 20
SCRIPT = "array<struct<op:string,a:string,b:string>>"


def _rows(a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
    """Edit distances of each start of a from all starts of b, a row at a time."""
    steps = np.arange(len(b) + 1)
    row = steps.copy()
    yield row
    for c in a:
        moved = np.minimum(row[:-1] + (b != c), row[1:] + 1)
        row = np.minimum.accumulate(np.concatenate([[row[0] + 1], moved]) - steps) + steps
        yield row


def _last(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    for row in _rows(a, b):
        pass
    return row


def _small(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    cost = np.stack(list(_rows(a, b)))
    i, j, out = len(a), len(b), []
    while i or j:
        if i and j and cost[i, j] == cost[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif i and cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
            out.append((a[i], -1))
        else:
            j -= 1
            out.append((-1, b[j]))
    return out[::-1]


def _pairs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Characters that meet; -1 for none. Memory grows with the texts' lengths, not their product: a is halved where the
    distances of both halves from the parts of b add up to least."""
    if len(a) < 2 or (len(a) + 1) * (len(b) + 1) <= CELLS:
        return _small(a, b)
    half = len(a) // 2
    at = int((_last(a[:half], b) + _last(a[half:][::-1], b[::-1])[::-1]).argmin())
    return _pairs(a[:half], b[:at]) + _pairs(a[half:], b[at:])


def edit_script(a: str, b: str) -> list[dict]:
    """Fewest edits that make a to b, as runs: keep (a is b), change (character for character), drop (b is empty), add."""
    x, y = (np.array([ord(c) for c in t], np.int64) for t in (a, b))
    same = 0
    while same < min(len(x), len(y)) and x[same] == y[same]:
        same += 1
    tail = 0
    while tail < min(len(x), len(y)) - same and x[len(x) - 1 - tail] == y[len(y) - 1 - tail]:
        tail += 1
    middle = _pairs(x[same : len(x) - tail], y[same : len(y) - tail])
    pairs = [(c, c) for c in x[:same]] + middle + [(c, c) for c in x[len(x) - tail :]]
    out: list[dict] = []
    for p, q in pairs:
        op = "keep" if p == q else "drop" if q < 0 else "add" if p < 0 else "change"
        if not out or out[-1]["op"] != op:
            out.append({"op": op, "a": [], "b": []})
        if p >= 0:
            out[-1]["a"].append(chr(p))
        if q >= 0:
            out[-1]["b"].append(chr(q))
    return [{"op": r["op"], "a": "".join(r["a"]), "b": "".join(r["b"])} for r in out]


def aligned_readings(a: DataFrame, b: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, text_a, text_b, script) of two runs' readings, side by side; a reading that one run lacks, or null, is empty.

    Where the texts are equal the script is made without leaving the JVM.
    """
    one, two = (df.select(*key, F.col(text).alias(n)) for df, n in ((a, "text_a"), (b, "text_b")))
    both = one.join(two, key, "full").select(*key, *[F.coalesce(n, F.lit("")).alias(n) for n in ("text_a", "text_b")])
    kept = F.when(F.col("text_a") == "", F.array().cast(SCRIPT)).otherwise(F.array(F.struct(F.lit("keep").alias("op"), F.col("text_a").alias("a"), F.col("text_b").alias("b"))).cast(SCRIPT))
    same, other = both.where("text_a = text_b").withColumn("script", kept), both.where("text_a <> text_b")
    kind = pa.list_(pa.struct([("op", pa.string()), ("a", pa.string()), ("b", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [edit_script(x, y) for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, kind)], [*batch.schema.names, "script"])

    made = other.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in other.schema.fields)}, script {SCRIPT}")
    return same.unionByName(made)


def script_sizes(aligned: DataFrame, key: list[str]) -> DataFrame:
    """(key, kept, changed, dropped, added, edits) in characters."""
    of = lambda op, side: F.aggregate(F.filter("script", lambda r: r["op"] == op), F.lit(0), lambda n, r: n + F.length(r[side]))
    sized = aligned.select(*key, of("keep", "a").alias("kept"), of("change", "a").alias("changed"), of("drop", "a").alias("dropped"), of("add", "b").alias("added"))
    return sized.withColumn("edits", F.col("changed") + F.col("dropped") + F.col("added"))


def confusions(aligned: DataFrame) -> DataFrame:
    """(a, b, n): how often a character of the first run stands where the second has another; '' for none."""
    runs = aligned.select(F.inline("script")).where("op <> 'keep'")
    at = lambda side: F.substring(F.col(side), F.col("i"), F.lit(1))
    each = runs.select("a", "b", F.explode(F.sequence(F.lit(1), F.greatest(F.length("a"), F.length("b")))).alias("i"))
    return each.select(at("a").alias("a"), at("b").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
