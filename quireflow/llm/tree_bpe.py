"""BPE encoding and decoding by tree concatenation.

A text is parted at white space, which no token crosses, and each chunk into the words that the vocabulary's own split
gives. A word of more than ``LEAF`` symbols is encoded in halves, and so are the halves; two encodings are joined by
encoding again a window of tokens around the place where they meet. The window grows until its first token is the left
side's and its last token the right side's (or it has reached that side's end). Then all tokens beyond the window stay:
a list of tokens is a text's encoding exactly if each two neighbours are the encoding of what both spell, and every pair
of neighbours of the joined list stands in one of three encodings, the left, the window's or the right.

Words of more than ``LONG`` symbols are not left to one task: their leaves are dealt to tasks as rows, and only the joins
are made where the document's ids come together again. The ids are the same either way.

Special tokens that a text spells are found first, as the tokenizers library does, and each text between them is normalised by itself.
Decoding joins the strings of the ids with a space, as the library does for a vocabulary without decoder.

Edge cases: null and empty texts, and texts of white space, have no tokens and decode to an empty text; an empty table
gives an empty result; repeated rows are coded one by one (each distinct chunk once a batch); null and repeated ids are
kept; ties do not arise, as merges have distinct ranks; texts and words of any length are coded whole; other columns
of the input are left alone, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stored, slices, table

#: Symbols of a word that are encoded at once; longer words are halved.
LEAF = 16
#: Symbols of a word from which on its leaves are dealt to tasks, and symbols of such a leaf.
LONG, DEALT = 1 << 16, 1 << 14
#: Distinct chunks whose ids a worker keeps, twice; longer chunks are not kept.
MEMORY, KEPT_CHARS = 300_000, 64
#: White space that the library's split knows and the text's own split() does not part at, and the other way round.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[^\\S\x1c-\x1f]+")


class TreeEncoder:
    """Ids of texts under a BPE vocabulary file whose words end with a suffix."""

    def __init__(self, vocabulary: str, leaf: int = LEAF):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(vocabulary, encoding="utf-8") as source:
            told = json.load(source)
        model, whole = told["model"], Tokenizer.from_file(vocabulary)
        vocab, merges = model["vocab"], [tuple(m) for m in model["merges"]]
        self.leaf, self.suffix = leaf, model["end_of_word_suffix"]
        # the same merges for text that ends a word and for text that goes on
        self._ending = BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.suffix)
        self._inner = BPE(vocab=vocab, merges=merges)
        self._normal, self._split = whole.normalizer, whole.pre_tokenizer
        self._special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self._specials = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        # what each id spells, without the suffix: a merged token ends a word if its right half does
        size = max([*vocab.values(), *self._special.values()]) + 1
        self.strings = [""] * size
        for token, i in (vocab | self._special).items():
            self.strings[i] = token
        ends = {vocab[t] for t in vocab if len(t) == 1 + len(self.suffix) and t.endswith(self.suffix)}
        for a, b in merges:
            if vocab[b] in ends:
                ends.add(vocab[a + b])
        self.spelt = [s[: -len(self.suffix)] if i in ends else s for i, s in enumerate(self.strings)]
        raw = [(s + " ").encode() for s in self.strings]
        self._lengths = np.array([len(r) for r in raw], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(raw), np.uint8)
        self._words: dict[str, bytes] = {}
        self._seen: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def at_once(self, symbols: str, ends: bool) -> list[int]:
        """Ids of a stretch of symbols, merged from its single symbols; ends: is it a word's end?"""
        return [t.id for t in (self._ending if ends else self._inner).tokenize(symbols)]

    def tree(self, symbols: str, ends: bool = True) -> list[int]:
        """Ids of a stretch of symbols, by halves."""
        if len(symbols) <= self.leaf:
            return self.at_once(symbols, ends)
        half = len(symbols) // 2
        return self.joined(self.tree(symbols[:half], False), self.tree(symbols[half:], ends), ends)

    def joined(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """Ids of what two encodings spell, one behind the other; ends: does the right one end its word?"""
        if not left or not right:
            return left or right
        size = 1
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            window = "".join(map(self.spelt.__getitem__, left[a:] + right[:b]))
            new = self.at_once(window, ends and b == len(right))
            if (a == 0 or new[0] == left[a]) and (b == len(right) or new[-1] == right[b - 1]):
                return left[:a] + new + right[b:]
            size *= 2

    def joined_all(self, parts: list[list[int]], ends: bool = True) -> list[int]:
        """Ids of neighbouring parts of one word, joined in pairs until one is left."""
        while len(parts) > 1:
            last = len(parts) - 2 + len(parts) % 2
            pairs = [self.joined(parts[i], parts[i + 1], ends and i + 1 == len(parts) - 1) for i in range(0, last, 2)]
            if len(parts) % 2:
                pairs.append(parts[-1])
            else:
                pairs.append(self.joined(parts[-2], parts[-1], ends))
            parts = pairs
        return parts[0] if parts else []

    def words(self, chunk: str) -> list[str]:
        """Words of a text without special tokens, in the vocabulary's symbols."""
        return [w for w, _ in self._split.pre_tokenize_str(self._normal.normalize_str(chunk))]

    def _word(self, word: str) -> bytes:
        if (ids := self._words.get(word)) is None:
            found = self.tree(word)
            ids = pack(f"<{len(found)}I", *found)
            if len(word) <= KEPT_CHARS:
                if len(self._words) >= MEMORY:
                    self._words = {}
                self._words[word] = ids
        return ids

    def _plain(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._word(chunk.lower())
        return b"".join(map(self._word, self.words(chunk)))

    def parts(self, chunk: str) -> list[str | int]:
        """Special ids and the texts between them."""
        if self._specials is None:
            return [chunk]
        return [self._special.get(p, p) for p in self._specials.split(chunk) if p]

    def _chunk(self, chunk: str) -> bytes:
        if (ids := self._older.get(chunk)) is None:
            ids = b"".join(p.to_bytes(4, "little") if isinstance(p, int) else self._plain(p) for p in self.parts(chunk)) if "<|" in chunk else self._plain(chunk)
        if len(chunk) <= KEPT_CHARS:
            self._seen[chunk] = ids
        return ids

    @staticmethod
    def chunks(text: str | None) -> list[str]:
        if not text:
            return []
        return text.split() if not _ODD_SPACE.search(text) else [c for c in _SPACE.split(text) if c]

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if len(self._seen) >= MEMORY:  # what is still in use moves on from the older half
            self._seen, self._older = {}, self._seen
        chunks = self.chunks(text)
        out: list = list(map(self._seen.get, chunks))
        at = -1
        try:
            while True:
                at = out.index(None, at + 1)
                out[at] = self._chunk(chunks[at])
        except ValueError:  # none is left
            return b"".join(out)

    def decode(self, coded: list[bytes]) -> list[str]:
        """The strings of ids with a space between them, for lists of ids."""
        ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int64)
        lengths = self._lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(self._starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])
        whole = self._bytes[places].tobytes()
        at = ends[np.cumsum([0] + [len(c) // 4 for c in coded])].tolist()
        return [whole[a : b - 1].decode() if b > a else "" for a, b in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> TreeEncoder:
    """One for each vocabulary and worker."""
    return TreeEncoder(vocabulary)


def _rows(batch: pa.RecordBatch, coded: list[bytes], coder: TreeEncoder) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(coded, pa.binary()), pa.array(coder.decode(coded), pa.string())], ["id", "ids", "decoded"])


def _in_one_task(plain: DataFrame, vocabulary: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in slices(batches, "t", 2 << 20):
            yield _rows(batch, [coder.encode(t) for t in batch.column("t").to_pylist()], coder)

    return plain.mapInArrow(run, f"id {kind}, ids binary, decoded string")


def _dealt(long: DataFrame, vocabulary: str, kind: str, dealt: int) -> DataFrame:
    """The same for rows (row, id, t), with the leaves of long words dealt to tasks.

    A piece is (row, no, word, ends, ids or symbols): pieces of one word are neighbours, word is null for ids of shorter words.
    """
    pieces = f"row bigint, id {kind}, no bigint, word bigint, ends boolean, symbols string, ids binary"
    names = ["row", "id", "no", "word", "ends", "symbols", "ids"]
    kinds = [pa.int64(), None, pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.binary()]

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in slices(batches, "t", 2 << 20):
            for row, i, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "t")), strict=True):
                out: list[tuple] = []
                held: list[bytes] = []

                def flush(out=out, held=held, row=row, i=i) -> None:
                    if held:
                        out.append((row, i, len(out), None, None, None, b"".join(held)))
                        held.clear()

                for chunk in coder.chunks(text):
                    if len(chunk) <= dealt:
                        held.append(coder.encode(chunk))
                        continue
                    for part in coder.parts(chunk):
                        if isinstance(part, int):
                            held.append(part.to_bytes(4, "little"))
                            continue
                        for word in coder.words(part):
                            if len(word) <= dealt:
                                held.append(coder._word(word))
                                continue
                            flush()
                            first = len(out)
                            for a in range(0, len(word), dealt):
                                out.append((row, i, len(out), first, a + dealt >= len(word), word[a : a + dealt], None))
                flush()
                if not out:
                    out.append((row, i, 0, None, None, None, b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field("id").type if k is None else k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in slices(batches, "symbols", 2 << 20):
            coded = []
            for symbols, ends, ids in zip(*(batch.column(c).to_pylist() for c in ("symbols", "ends", "ids")), strict=True):
                if symbols is not None:
                    found = coder.tree(symbols, ends)
                    ids = pack(f"<{len(found)}I", *found)
                coded.append(ids)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(coded, pa.binary())], [*names[:5], "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        now, done, word, parts, ends = None, [], None, [], True

        def close_word() -> None:
            if parts:
                found = coder.joined_all([np.frombuffer(p, "<u4").tolist() for p in parts], ends)
                done.append(pack(f"<{len(found)}I", *found))
                parts.clear()

        def row_of(now: tuple, kind_: pa.DataType) -> pa.RecordBatch:
            close_word()
            ids = b"".join(done)
            done.clear()
            return _rows(pa.RecordBatch.from_arrays([pa.array([now[1]], kind_)], ["id"]), [ids], coder)

        kind_ = None
        for batch in batches:
            kind_ = batch.schema.field("id").type
            for row, i, w, e, ids in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "word", "ends", "ids")), strict=True):
                if now is not None and now[0] != row:
                    yield row_of(now, kind_)
                if now is None or now[0] != row:
                    now, word = (row, i), None
                if w is None or w != word:
                    close_word()
                word = w
                if w is None:
                    done.append(ids)
                else:
                    parts.append(ids)
                    ends = e
        if now is not None:
            yield row_of(now, kind_)

    spread = long.mapInArrow(parted, pieces).repartition(F.xxhash64("row", "no"))
    coded = spread.mapInArrow(leaves, f"row bigint, id {kind}, no bigint, word bigint, ends boolean, ids binary")
    return coded.repartition("row").sortWithinPartitions("row", "no").mapInArrow(joined, f"id {kind}, ids binary, decoded string")


def coded_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, dealt: int = DEALT) -> DataFrame:
    """Per row: id, ids (binary: little-endian unsigned 32 bits) and decoded, the text that the ids decode to.

    Rows with a run of more than ``long`` characters without a space are written to shared storage with a number of their own, so that their leaves can be dealt to tasks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    # a run is looked at from its beginning only, so the search is linear
    unsplit = F.coalesce((F.length("t") >= long) & F.col("t").rlike(rf"(?:^|\s)\S{{{long}}}"), F.lit(False))
    held = Stored(plain.where(unsplit).select(F.monotonically_increasing_id().alias("row"), "id", "t"), "unsplit")
    out = _in_one_task(plain.where(~unsplit), vocabulary, kind).unionByName(_dealt(held.df, vocabulary, kind, dealt))
    return out.withColumnRenamed("id", id_col)


def op11_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: number of tokens, digest of the ids, and digest of the text that they decode to."""
    import public_tokenizers

    done = coded_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
