"""Sequence packing along a space-filling curve.

Every document is tokenised once; its hashed token vector is projected to a few dimensions and turned into a
Hilbert key. Rows are range-sorted by (key, id), so documents near each other on the curve meet in one partition and
large groups of equal keys are split by id. Each partition is one gapless token stream, cut at every
``capacity`` ids; the last, short stretch is cut at powers of two, so no sequence holds padding.

Edge cases: a null text counts as empty and still has the closing id; an empty table gives no pieces; equal rows
and ties of the key are ordered by id; long texts are cut over as many sequences as they need; other columns of
the input are left alone. Sequence numbers are unique, ordered along the curve, and not dense across partitions.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stored, slices, table

#: Stored bytes that a range of the curve has, about.
RANGE_BYTES = 32 << 20
CAPACITY, END_ID, DIMS, BITS, BUCKETS = 2048, 1, 4, 12, 256
#: Distinct chunks whose ids a worker keeps, twice; texts themselves are never cut for it.
MEMORY = 300_000


def _packed(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class ChunkEncoder:
    """The vocabulary's ids of whole texts, remembered by chunk.

    The split pattern joins at most one space to what follows it, so a text may be parted before every space that
    precedes a character other than white space: no token crosses such a place, and equal chunks have equal ids.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        # pattern of the byte-level vocabulary (a fixed value)
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoder = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
        self._one = self._encoder._core_bpe.encode_single_piece
        self._marks = {m: _packed(self._one(m.encode())) for m in ".,;:!?"}
        self._seen: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _code(self, chunk: str) -> bytes:
        if "<|" in chunk:
            return _packed(self._encoder.encode(chunk, allowed_special="all"))
        return _packed(self._encoder.encode_ordinary(chunk))

    def _new(self, part: str) -> bytes:
        """Ids of a part with the space before it. Letters, and letters with a closing mark, are single steps of the split pattern."""
        if (ids := self._older.get(part)) is None:
            if part.isalpha():
                ids = _packed(self._one(b" " + part.encode()))
            elif part[-1] in self._marks and part[:-1].isalpha():
                stem = part[:-1]
                if (ids := self._seen.get(stem) or self._older.get(stem)) is None:
                    ids = self._seen[stem] = _packed(self._one(b" " + stem.encode()))
                ids += self._marks[part[-1]]
            else:
                ids = self._code(" " + part)
        if len(part) <= 64:
            self._seen[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if len(self._seen) >= MEMORY:  # what is still in use moves on from the older half
            self._seen, self._older = {}, self._seen
        parts = text.split(" ")
        out: list[bytes | None] = list(map(self._seen.get, parts))
        out[0] = self._code(parts[0]) if parts[0] else b""
        end = 0
        while True:
            try:
                i = out.index(None, end)
            except ValueError:
                return b"".join(out)
            part, end = parts[i], i + 1
            if part and not part[0].isspace():
                out[i] = self._new(part)
                continue
            # white space before white space stays with what stands before it
            while end < len(parts) and (not parts[end] or parts[end][0].isspace()):
                end += 1
            before = (" " if i > 1 else "") + parts[i - 1]
            out[i - 1 : end] = [self._code(" ".join([before, *parts[i:end]]))] + [b""] * (end - i)


def projection(n_ids: int, dims: int = DIMS, buckets: int = BUCKETS) -> np.ndarray:
    """Row per token id: its signed hash bucket, sent to few dimensions by fixed random directions."""
    x = np.arange(n_ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    sign = np.where(x & np.uint64(1), 1.0, -1.0)
    directions = np.random.default_rng(7).normal(size=(buckets, dims))
    return (sign[:, None] * directions[(x >> np.uint64(8)).astype(np.int64) % buckets]).astype(np.float32)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of unsigned coordinates below 2**bits (Skilling's transform, 2004)."""
    x = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(len(x)):
            high = (x[d] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
        q >>= 1
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << 1) | (((x[d] ^ turn) >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray], table_: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert key of each document from the mean of its projected token vectors."""
    means = np.stack([table_[i].mean(axis=0) if len(i) else np.zeros(table_.shape[1], np.float32) for i in ids])
    cells = ((np.tanh(3 * means) + 1) / 2 * (2**bits - 1)).astype(np.int64)
    return hilbert_keys(cells, bits)


def tokenize(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Per row: id, curve_key long, ids binary (little-endian unsigned 32 bits, closing id included)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, close = ChunkEncoder(vocabulary), np.array([end_id], "<u4").tobytes()
        rows = projection(65_536)
        for batch in slices(batches, "t", 4 << 20):
            coded = [encoder.encode(t or "") + close for t in batch.column("t").to_pylist()]
            keys = curve_keys([np.frombuffer(c, "<u4")[:-1] for c in coded], rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.int64()), pa.array(coded, pa.binary())], ["id", "curve_key", "ids"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, curve_key bigint, ids binary")


def cut(documents: Iterator[tuple[object, int]], capacity: int) -> Iterator[tuple[object, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece of one stream of (document, number of ids)."""
    sequence, fill = 0, 0
    held: list[tuple[object, int, int]] = []
    for doc, n in documents:
        start = 0
        while start < n:
            take = min(n - start, capacity - fill)
            held.append((doc, start, take))
            start, fill = start + take, fill + take
            if fill == capacity:
                offset = 0
                for d, s, k in held:
                    yield d, s, k, sequence, offset
                    offset += k
                sequence, fill, held = sequence + 1, 0, []
    room, offset = (1 << fill.bit_length() - 1 if fill else 0), 0
    for d, s, k in held:
        while k:
            take = min(k, room - offset)
            yield d, s, take, sequence, offset
            s, k, offset, fill = s + take, k - take, offset + take, fill - take
            if offset == room and fill:
                room, offset, sequence = 1 << fill.bit_length() - 1, 0, sequence + 1


PIECES = "start bigint, length bigint, piece binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents along the curve, each with its ids (piece: little-endian unsigned 32 bits)."""
    if capacity & (capacity - 1):
        raise ValueError("capacity is a power of two")
    held = Stored(tokenize(docs, vocabulary, id_col, text_col), "tokens")
    coded = held.df
    id_type = coded.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[object, bytes], int]]:
        for batch in batches:
            for i, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                yield (i, ids), len(ids) // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        size = 0
        for (i, ids), start, length, sequence, offset in cut(rows(batches), capacity):
            out.append((i, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, first + sequence, offset))
            size += length
            if size >= 1 << 20:
                yield batch_of(out)
                out, size = [], 0
        if out:
            yield batch_of(out)

    names = ["id", "start", "length", "piece", "doc_tokens", "sequence_id", "offset"]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    # as many ranges as keep each one's rows within RANGE_BYTES, however much there is
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held.n_bytes() // RANGE_BYTES))
    along = coded.repartitionByRange(ranges, "curve_key", "id").sortWithinPartitions("curve_key", "id")
    return along.mapInArrow(run, f"id {id_type}, {PIECES}").withColumnRenamed("id", id_col)


def pack_query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed.select("doc_id", "start", "length", F.crc32("piece").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids; ids_crc32 is taken from each piece's ids."""
    return pack_query(table(spark, sf_dir, "documents"))
