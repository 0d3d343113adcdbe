"""Vector codes by product quantisation; nearest codebook entries are found in a ball tree for each part of the vector.

Entries become integers (``scale`` times the entry, floored) and a vector is cut into equal parts. Each part position has a codebook, first the
parts of the vectors with the smallest ids, then ``rounds`` times the floored means of the parts that are nearest to
each entry. Executors add parts up by entry; what reaches the driver is one row for each entry, whatever the number of vectors.

The search is exact. A tree's balls have whole-numbered centres and radii that are rounded up, a query's distance from a
centre is rounded down, and a ball is visited unless its bound is greater than (not: as great as) the best distance
so far, so that equal distances are all seen and the lower entry wins. Distances are integers throughout: floats are
used only where they hold every intermediate value exactly. A task searches a batch of parts together: first each part's
nearest ball by centre, for a good bound, then the tree from its root with the parts that must visit a ball.

Edge cases: rows whose vector is null or holds null, NaN or infinite entries are dropped; rows without an id are coded but give no first entries; repeated
ids are taken by (id, vector), so repeated rows may give several equal entries, of which the lowest is used; fewer rows than
entries give a smaller codebook, none (an empty table, or no ids) no rows; entries nothing is nearest to stay; null labels are one label; other
columns are left alone. Vectors of different lengths, lengths that do not divide into the parts and entries whose floor is no 64-bit integer are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stored, table
from .whitening import EXACT, matrix_of, usable, whole_entries

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Entries of a ball that is not divided.
LEAF = 16
#: Labels with more than one in so many of all rows are joined by broadcast: at most so many rows.
HOT_LABELS = 10_000


def _squared(q: np.ndarray, e: np.ndarray, bound: int) -> np.ndarray:
    """Exact squared distances of all q from all e; bound: no entry's absolute value is greater."""
    if 4 * q.shape[1] * bound * bound < EXACT:
        q, e = q.astype(np.float64, copy=False), e.astype(np.float64, copy=False)
        return (q * q).sum(axis=1)[:, None] - 2.0 * (q @ e.T) + (e * e).sum(axis=1)
    kind = np.int64 if 4 * q.shape[1] * bound * bound < 1 << 62 else object
    q, e = q.astype(kind), e.astype(kind)
    return np.stack([((q - row) ** 2).sum(axis=1) for row in e], axis=1)


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(squared).astype(np.float64))


class BallTree:
    """Entries of one codebook (rows of integers) in nested balls."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF):
        self.entries = np.asarray(entries, dtype=np.int64)
        self.bound = int(np.abs(self.entries).max(initial=0))
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.members: list[np.ndarray] = []
        self._leaf = leaf
        self._divide(np.arange(len(self.entries)))
        self.leaves = [i for i, c in enumerate(self.children) if c is None]

    def _divide(self, members: np.ndarray) -> int:
        """Adds the ball of some entries, and those of its halves along the widest dimension; its number."""
        own = self.entries[members]
        centre = np.array([int(c) // len(own) for c in own.sum(axis=0, dtype=object)], np.int64)
        farthest = _squared(own, centre[None], max(self.bound, int(np.abs(centre).max(initial=0)))).max()
        at = len(self.members)
        self.members.append(members)
        self.centres.append(centre)
        self.radii.append(float(_root(farthest)) * (1 + 1e-12))
        self.children.append(None)
        if len(members) > self._leaf:
            spread = own.max(axis=0).astype(np.float64) - own.min(axis=0)
            order = members[np.argsort(own[:, int(spread.argmax())], kind="stable")]
            half = len(order) // 2
            self.children[at] = (self._divide(np.sort(order[:half])), self._divide(np.sort(order[half:])))
        return at

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each query; of equally near entries the lowest."""
        bound = max(self.bound, int(np.abs(queries).max(initial=0)))
        exact = 4 * queries.shape[1] * bound * bound < EXACT
        q = queries.astype(np.float64) if exact else queries
        apart = _squared(q, np.stack(self.centres), bound)
        # no query is nearer to an entry of a ball than this: its distance from the centre, rounded down, less the radius, rounded up
        least = np.maximum(_root(apart) * (1 - 1e-12) - np.array(self.radii), 0.0)
        least = least * least * (1 - 1e-12)
        best = np.full(len(q), np.inf) if apart.dtype == np.float64 else np.full(len(q), 1 << 200, dtype=object)
        found = np.zeros(len(q), np.int64)
        leaves = np.array(self.leaves)
        first = leaves[apart[:, leaves].astype(np.float64).argmin(axis=1)]

        def visit(node: int, some: np.ndarray) -> None:
            members = self.members[node]
            apart_ = _squared(q[some], self.entries[members], bound)
            column = apart_.argmin(axis=1)
            distance, entry = apart_[np.arange(len(some)), column], members[column]
            better = (distance < best[some]) | ((distance == best[some]) & (entry < found[some]))
            best[some[better]], found[some[better]] = distance[better], entry[better]

        for node in self.leaves:
            if len(some := np.flatnonzero(first == node)):
                visit(node, some)
        waiting = [(0, np.arange(len(q)))]
        while waiting:
            node, some = waiting.pop()
            some = some[least[some, node] <= best[some].astype(np.float64) * (1 + 1e-12)]
            if not len(some):
                continue
            if (halves := self.children[node]) is not None:
                waiting += [(h, some) for h in reversed(halves)]
            elif len(some := some[first[some] != node]):
                visit(node, some)
        return found, best.astype(np.int64)


class Codebooks:
    """Per part position: entries (rows of integers)."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books

    @property
    def sha256(self) -> str:
        """Digest of all entries' components by part, entry and position."""
        return hashlib.sha256(",".join(str(int(v)) for book in self.books for v in book.reshape(-1)).encode()).hexdigest()

    def search(self, trees: list[BallTree], x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        width = x.shape[1] // len(self.books)
        return [tree.nearest(x[:, p * width : (p + 1) * width]) for p, tree in enumerate(trees)]


def first_codebooks(rows: DataFrame, id_col: str, parts: int, entries: int) -> Codebooks:
    """Parts of the vectors with the smallest ids; sorted by the executors, and only so many reach the driver."""
    seeds = rows.where(F.col(id_col).isNotNull()).orderBy(id_col, "x").select("x").limit(entries).collect()
    x = np.array([r.x for r in seeds], dtype=np.int64)
    return Codebooks(np.split(x, parts, axis=1) if len(x) else [])


def improved(rows: DataFrame, books: Codebooks, dims: int) -> Codebooks:
    """One round: entries become the floored means of the parts nearest to them; those of no part stay."""
    parts, width = len(books.books), dims // len(books.books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [BallTree(b) for b in books.books]
        sums = [np.zeros((len(b), width), np.int64) for b in books.books]
        counts = [np.zeros(len(b), np.int64) for b in books.books]

        def told() -> pa.RecordBatch:
            used = [(p, e) for p in range(parts) for e in np.flatnonzero(counts[p])]
            values = [sums[p][e].copy() for p, e in used]
            flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * width, flat)
            n = [int(counts[p][e]) for p, e in used]
            for s, c in zip(sums, counts, strict=True):
                s[:] = 0
                c[:] = 0
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in used], pa.int32()), pa.array([int(e) for _, e in used], pa.int32()), pa.array(n, pa.int64()), lists], ["part", "entry", "n", "sums"])

        seen, most = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"), dims)
            seen, most = seen + len(x), max(most, int(np.abs(x).max(initial=0)))
            if seen * most >= 1 << 62:  # what is summed so far leaves before it could overflow
                yield told()
                seen = len(x)
            for p, (entry, _) in enumerate(books.search(trees, x)):
                np.add.at(sums[p], entry, x[:, p * width : (p + 1) * width])
                counts[p] += np.bincount(entry, minlength=len(counts[p]))
        yield told()

    partial = rows.select("x").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    totals = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)])
    new = [b.copy() for b in books.books]
    for r in totals.collect():  # a row for each entry at most
        new[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return Codebooks(new)


def coded(rows: DataFrame, books: Codebooks, dims: int, id_col: str, label_col: str) -> DataFrame:
    """Per row: id, label, code (two hex digits a part) and error."""
    kinds = [rows.schema[c].dataType.simpleString() for c in (id_col, label_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [BallTree(b) for b in books.books]
        for batch in batches:
            if batch.num_rows:
                found = books.search(trees, matrix_of(batch.column("x"), dims))
                codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
                text, width = codes.tobytes().hex(), 2 * codes.shape[1]
                error = sum(apart for _, apart in found)
                hexed = pa.array([text[i : i + width] for i in range(0, len(text), width)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), hexed, pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    plain = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), "x")
    return plain.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, code string, error bigint")


def with_label_error(rows: DataFrame, one_in: int = HOT_LABELS) -> DataFrame:
    """rows (label, error, ...) with label_error, the sum over a label's rows; null is a label.

    Labels that hold more than one in ``one_in`` of all rows are at most ``one_in``, which bounds their broadcast; the
    others' rows are shuffled, and no key of theirs is hot.
    """
    sums = Stored(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")), "label_errors")
    n = sums.df.agg(F.sum("_n")).first()[0] or 0
    hot = sums.df.where(F.col("_n") * one_in > n).select(F.col("label").alias("_label"), "label_error")
    rest = sums.df.where(F.col("_n") * one_in <= n).select(F.col("label").alias("_label"), "label_error")
    met = rows.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    cold = met.where(F.col("label_error").isNull()).drop("label_error").join(rest, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return met.where(F.col("label_error").isNotNull()).unionByName(cold)


CODES = "code string, error bigint, label_error bigint, codebooks_sha256 string"


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """(id, code, error, label_error, codebooks_sha256) of each usable row, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for each part")
    usable_ = vectors.where(usable(vector_col)).select(F.col(id_col), F.col(label_col), whole_entries(vector_col, scale).alias("x"))
    rows = Stored(usable_, "vectors").df
    sizes = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    dims = sizes.most or 0
    if sizes.least != sizes.most or dims % parts:
        raise ValueError(f"vectors have {sizes.least} to {sizes.most} entries, for {parts} equal parts")
    books = first_codebooks(rows, id_col, parts, entries) if dims else Codebooks([])
    if not books.books:
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"id {kind}, {CODES}").withColumnRenamed("id", id_col), books
    for _ in range(rounds):
        books = improved(rows, books, dims)
    done = with_label_error(Stored(coded(rows, books, dims, id_col, label_col), "vector_codes").df)
    return done.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256")), books


def op13_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings: code, error, error by label, and the digest of the codebooks."""
    return vector_codes(table(spark, sf_dir, "embeddings"))[0]
