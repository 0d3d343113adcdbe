"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint has a bit set if more than half of its word shingles' hashes have it. Equal fingerprints
are merged first. Distinct ones are then compared exactly, in tiles: two fingerprints within the radius agree on
at least B - radius of B bit blocks, so tiles are made per choice of agreeing blocks and their value (no pair within
the radius is lost, whatever B). Groups larger than a tile are split by population count and salt, and only tile
pairs whose population counts are within the radius are formed; inside a tile pair, numpy compares sub-tiles by
exclusive-or and bit counts, again skipping those too far apart in population count. A tile pair answers with a
spanning forest of its links, never with all pairs.

Edge cases: a text without words (null included) has fingerprint zero and links like any other; fewer words than a
shingle count as one shingle; an empty table gives no rows; equal rows stay separate rows of one group; a null id
keeps its row and never names a group (a group of null ids only has a null id); other columns are left alone.

Near copies by Jaccard similarity lie further apart: at 0.8 some 15 % of the bits differ, too many for blocks that agree. For
those (``grouped_sketches``) a text has a fingerprint of 512 bits, of its distinct shingles, whose differing bits tell the similarity to
about 0.04, and tiles are made per band of minimum hashes; within tiles the comparison is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import acos, comb, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, lowered_words, slices, stored, table
from .components import components

SHINGLE, RADIUS, SEED, TILE, SUB_TILE = 4, 4, 42, 4096, 512
#: Words a shingle and the Jaccard similarity of near copies; 64-bit words of their fingerprints; bands of minimum hashes, and hashes a band.
SKETCH_SHINGLE, SIMILARITY, WORDS, BANDS, BAND_ROWS = 5, 0.8, 8, 8, 4
#: Shingles that are hashed anew at a time.
PART = 4096


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of a whole text's word shingles, repeats included; none for a text without words."""
    words = lowered_words(text)
    if not words:
        return np.empty(0, "<u8")
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0] + [e + 1 for e in ends]
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :])), dtype="<u8", count=n)  # noqa: B905


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text's word shingles, unsigned."""
    hashes = shingle_hashes(text, shingle)
    n = len(hashes)
    if not n:
        return 0
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: id and fp, the fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("t").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, fp bigint").withColumnsRenamed({"id": id_col})


def mixed(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A row of new 64-bit hashes for each seed (a multiply and shift finaliser)."""
    x = hashes[None, :] + seeds[:, None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(text: str | None, shingle: int = SKETCH_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """WORDS words of a whole text's long fingerprint, and BANDS keys of minimum hashes, as signed longs; zeros without words."""
    hashes = np.unique(shingle_hashes(text, shingle))
    if not len(hashes):
        return np.zeros(WORDS, np.int64), np.zeros(BANDS, np.int64)
    seeds = np.arange(1, WORDS + BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    set_bits, least = np.zeros((WORDS, 64), np.int64), np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), PART):
        new = mixed(hashes[at : at + PART], seeds)
        bits = np.unpackbits(np.ascontiguousarray(new[:WORDS]).view(np.uint8).reshape(WORDS, -1, 8), axis=2, bitorder="little")
        set_bits += bits.sum(axis=1, dtype=np.int64)
        least = np.minimum(least, new[WORDS:].min(axis=1))
    words = np.packbits(2 * set_bits > len(hashes), axis=1, bitorder="little").view("<i8").reshape(-1)
    bands = np.array([xxhash.xxh64_intdigest(b.tobytes(), SEED) for b in least.reshape(BANDS, BAND_ROWS)], np.uint64)
    return words, bands.view(np.int64)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SKETCH_SHINGLE) -> DataFrame:
    """Per row: id, words and bands of its sketch."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            both = [sketch(t, shingle) for t in batch.column("t").to_pylist()]
            arrays = [pa.array([x[i] for x in both], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", "words", "bands"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, words array<bigint>, bands array<bigint>").withColumnsRenamed({"id": id_col})


def sketch_radius(similarity: float = SIMILARITY) -> int:
    """Differing bits that two texts' long fingerprints have at this Jaccard similarity of their shingles: the mean and one standard deviation."""
    share = acos(2 * similarity / (1 + similarity)) / pi
    return round(64 * WORDS * share + sqrt(64 * WORDS * share * (1 - share)))


def block_masks(n: int, radius: int) -> list[int]:
    """A bit mask for each choice of agreeing blocks; the number of blocks is what costs least for n fingerprints."""

    def cost(blocks: int) -> float:
        bits = 64 * (blocks - radius) / blocks
        return comb(blocks, radius) * (n * 1e-6 + n * n / 2**bits * 1.5e-9)

    blocks = min(range(radius + 1, radius + 5), key=cost)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(parts[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def forest(fps: np.ndarray, sides: np.ndarray, radius: int) -> np.ndarray:
    """For rows (one word each, or several) sorted by population count: the index each hangs from in a spanning forest of links across sides.

    sides are all zero to compare a tile with itself; otherwise only rows of different sides are compared.
    """
    n = len(fps)
    words = fps.reshape(n, -1)
    label, counts = np.arange(n), np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    cross = bool(sides.any()) and not sides.all()
    left, right = (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)) if cross else (np.arange(n), np.arange(n))
    for a in range(0, len(left), SUB_TILE):
        i = left[a : a + SUB_TILE]
        for b in range(0 if cross else a, len(right), SUB_TILE):
            j = right[b : b + SUB_TILE]
            if int(counts[j[0]]) - int(counts[i[-1]]) > radius:
                break
            if int(counts[i[0]]) - int(counts[j[-1]]) > radius:
                continue
            apart = sum(np.bitwise_count(w[i][:, None] ^ w[j][None, :]).astype(np.uint16) for w in words.T)
            near = apart <= radius
            for row in np.flatnonzero(near.sum(axis=1) > (0 if cross else a == b)):
                met = np.unique(np.append(label[j[near[row]]], label[i[row]]))
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
            if not label.any():
                return label
    return label


def _tile_links(radius: int, words: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile pair and population count; a tile pair may run on into the next batch."""
        held: list[np.ndarray] = []
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("mask", "value", "lo", "hi", "side", "fp", *words)]
            rows = np.stack(columns, axis=1)
            if held:
                rows = np.concatenate([*held, rows])
            if not len(rows):
                continue
            starts = np.flatnonzero(np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)])
            held = [rows[starts[-1] :]]
            yield from links_of(rows, starts)
        if held:
            yield from links_of(held[0], np.array([0, len(held[0])]))

    def links_of(rows: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        sizes = np.diff(starts)
        for at, n in zip(starts[:-1][sizes > 1], sizes[sizes > 1], strict=True):
            fps = rows[at : at + n, 5]
            bits = rows[at : at + n, 6:] if words else fps
            label = forest(np.ascontiguousarray(bits).view(np.uint64), rows[at : at + n, 4], radius)
            moved = np.flatnonzero(label != np.arange(n))
            if len(moved):
                found.append(np.stack([fps[moved], fps[label[moved]]], axis=1))
        if found:
            both = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect whatever fingerprints (column fp, distinct) within the radius connect."""
    masks = block_masks(distinct.count(), radius)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), (F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))).alias("value")) for i, m in enumerate(masks)]))
    rows = distinct.select("fp", F.bit_count("fp").cast("int").alias("ones"), choice.alias("c")).select("fp", "ones", "c.mask", "c.value")
    return tiled(rows, radius, tile)


def sketch_links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(a, b) of rows (fp, words, bands), fp being any distinct long: links that connect whatever fingerprints within the radius connect, of
    those that have a band in common. Counts of set bits are told apart in steps of a quarter of the radius."""
    words = [f"w{i}" for i in range(WORDS)]
    plain = distinct.select("fp", "bands", *[F.get("words", i).alias(w) for i, w in enumerate(words)])
    ones = sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0])).cast("int")
    return tiled(plain.select("fp", *words, ones.alias("ones"), F.posexplode("bands").alias("mask", "value")), radius, tile, words, max(1, radius // 4))


def tiled(rows: DataFrame, radius: int, tile: int, words: list[str] | None = None, step: int = 1) -> DataFrame:
    """(a, b): links of rows (fp, ones, mask, value) that share mask and value; words: columns of the bits that are compared (none: fp)."""
    words, exact = words or [], "ones" if step == 1 else "exact"
    reach = -(-radius // step)
    if step > 1:
        rows = rows.withColumn("exact", F.col("ones")).withColumn("ones", F.floor(F.col("ones") / step).cast("int"))
    cells = rows.groupBy("mask", "value", "ones").agg(F.count(F.lit(1)).alias("n"))
    # only groups of more than one tile: their cells, at most 65, each with its number of salted tiles
    large = (
        cells.groupBy("mask", "value")
        .agg(F.sum("n").alias("total"), F.collect_list(F.struct(F.col("ones").alias("of"), F.ceil(F.col("n") / tile).cast("int").alias("tiles"))).alias("cells"))
        .where(F.col("total") > tile)
        .drop("total")
    )
    joined = rows.join(large, ["mask", "value"], "left")
    own = F.element_at(F.filter("cells", lambda c: c["of"] == F.col("ones")), 1)
    code = lambda ones, salt: ones * F.lit(1 << 20) + salt
    mine = F.when(F.col("cells").isNull(), F.lit(0)).otherwise(code(F.col("ones"), F.pmod(F.xxhash64("fp"), own["tiles"]).cast("int")))
    near = F.filter("cells", lambda c: F.abs(c["of"] - F.col("ones")) <= reach)
    others = F.when(F.col("cells").isNull(), F.array(F.lit(0))).otherwise(
        F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0), c["tiles"] - 1), lambda s: code(c["of"], s))))
    )
    own_columns = ["fp", exact, "mask", "value", *words]
    pairs = joined.select(*own_columns, mine.alias("mine"), others.alias("others")).select(*own_columns, "mine", F.explode("others").alias("other"))
    dealt = pairs.select(
        *own_columns, F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), (F.col("mine") > F.col("other")).cast("int").alias("side")
    )
    keys = ["mask", "value", "lo", "hi"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, exact).mapInArrow(_tile_links(radius, words), "a bigint, b bigint")


def grouped(coded: DataFrame, id_col: str, radius: int = RADIUS) -> DataFrame:
    """(fp, first) of rows (id, fp) that were stored: the smallest id of each fingerprint's group, a row per fingerprint.

    Joins on fp and root are of distinct fingerprints, so a group of copies is one row there.
    """
    distinct = stored(coded.groupBy("fp").agg(F.min(id_col).alias("first_id")), "distinct")
    return _firsts(distinct, fingerprint_links(distinct.select("fp"), radius))


def grouped_sketches(coded: DataFrame, id_col: str, similarity: float = SIMILARITY) -> DataFrame:
    """(fp, first) of rows (id, words, bands) that were stored: the smallest id of each group of near copies, a row per long fingerprint."""
    one = coded.groupBy("words").agg(F.min(id_col).alias("first_id"), F.min("bands").alias("bands"))
    distinct = stored(one.select(F.xxhash64("words").alias("fp"), "words", "bands", "first_id"), "distinct")
    return _firsts(distinct.select("fp", "first_id"), sketch_links(distinct.select("fp", "words", "bands"), sketch_radius(similarity)))


def _firsts(distinct: DataFrame, links: DataFrame) -> DataFrame:
    roots = components(links, "a", "b")
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("first"))
    return rooted.join(named, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: id, fp (signed long) and component_id, the smallest id of its group (with an underscore if the id has that name)."""
    plain = docs.select(F.col(id_col).alias("_sh_id"), F.col(text_col).alias("_sh_text"))
    coded = stored(fingerprints(plain, "_sh_id", "_sh_text", shingle), "fingerprints")
    of = stored(grouped(coded, "_sh_id", radius).withColumnRenamed("first", "component_id"), "groups")
    taken = plain.select(F.col("_sh_id").alias(id_col))
    return coded.join(of, "fp").select(F.col("_sh_id").alias(id_col), F.col("fp").alias(free_name(taken, "fp")), F.col("component_id").alias(free_name(taken, "component_id")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: fingerprint in hexadecimal and the smallest reachable doc_id."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
