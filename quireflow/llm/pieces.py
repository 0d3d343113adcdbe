"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

Text is marked as the format has it (a leading mark, spaces as marks) and parted into marked words; no piece of the
vocabulary crosses from a word's characters into the next mark, so words are coded independently. The distinct words of a
batch are sorted, which is the depth-first order of their trie: each word keeps the forward scores of the prefix that it
shares with the word before and is searched behind it only. A position looks for the pieces that end there in a
trie of the vocabulary, kept from each piece's last character to its first, and stops where no piece goes on.
Characters without a piece become byte pieces after the search.

Ids are those of the best total score under the vocabulary's scores. The text itself is coded: a normaliser that a model file
may name is not applied, so that every text is restored.

Edge cases: null and empty texts have no pieces and decode to an empty text; an empty table gives an empty result;
repeated rows are coded one by one (each distinct word once a batch); ties go to the longer last piece; a mark written in the text itself decodes to a
space, as the format has it, and is reported as not restored; other columns are left alone. Texts of any length are
coded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

MARK = "▁"
#: What an unknown character costs below the worst piece (a fixed value of the format).
UNKNOWN_PENALTY = 10.0
#: Distinct words whose ids a worker keeps, twice.
MEMORY = 200_000
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces and scores of a model file."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.scores = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.ids = {self.pieces[i]: i for i in plain}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown_score = min(self.scores.values()) - UNKNOWN_PENALTY
        #: Nodes by a piece's characters from last to first; the empty key holds the score of the piece that is complete.
        self.trie: dict = {}
        for piece, score in self.scores.items():
            node = self.trie
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        # what each id spells
        spelt = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            spelt[i] = bytes([value])
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.lengths = np.array([len(x) for x in spelt], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._seen: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def search(self, words: list[str]) -> list[bytes]:
        """Ids of sorted distinct marked words, little-endian unsigned 32 bits.

        best and back hold, for a word's first i characters, the score and the start of the last piece. They depend on those
        characters only, so what a word shares with the one before is kept.
        """
        trie, unknown, out = self.v.trie, self.v.unknown_score, []
        best, back, last = [0.0], [0], ""
        for word in words:
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            del best[same + 1 :], back[same + 1 :]
            for start in range(same, len(word)):
                top, at, node = best[start] + unknown, start, trie.get(word[start])
                while node is not None:
                    if (s := node.get("")) is not None and (s := best[start] + s) >= top:
                        top, at = s, start
                    start -= 1
                    node = node.get(word[start]) if start >= 0 else None
                best.append(top)
                back.append(at)
            last, end, found = word, len(word), []
            while end:
                start = back[end]
                found.append(self._ids(word[start:end]))
                end = start
            out.append(b"".join(reversed(found)))
        return out

    def _ids(self, piece: str) -> bytes:
        """Ids of a piece, or of an unknown character's bytes."""
        if (i := self.v.packed.get(piece)) is not None:
            return i
        raw = piece.encode("utf-8", "surrogatepass")
        return b"".join((self.v.bytes[b] if self.v.bytes else self.v.unknown).to_bytes(4, "little") for b in (raw if self.v.bytes else raw[:1]))

    @staticmethod
    def _parted(text: str | None) -> list[str]:
        """Marked words, those with one mark and nothing else special without it."""
        if not text:
            return []
        parts = text.split(" ")
        if "" not in parts and MARK not in text:
            return parts
        return [w[1:] if w.rfind(MARK) == 0 and len(w) > 1 else w for w in _WORDS.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        parted = [self._parted(t) for t in texts]
        new: set[str] = set()
        for words in parted:
            new.update(words)
        if len(self._seen) >= MEMORY:  # what is still in use moves on from the older half
            self._seen, self._older = {}, self._seen
        new.difference_update(self._seen)
        for word in new.intersection(self._older):
            self._seen[word] = self._older[word]
        new.difference_update(self._older)
        marked = {w if w[0] == MARK else MARK + w: w for w in new}
        ordered = sorted(marked)
        self._seen.update(zip(map(marked.__getitem__, ordered), self.search(ordered), strict=True))
        ids = self._seen.__getitem__
        return [b"".join(map(ids, words)) for words in parted]


def decode(vocabulary: Vocabulary, coded: list[bytes]) -> list[str]:
    """The texts of lists of ids (little-endian unsigned 32 bits); byte pieces become the characters they spell."""
    ids = np.frombuffer(b"".join(coded), "<u4")
    lengths = vocabulary.lengths[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    # each byte's place in the spelt pieces: its piece's start there, and how far it is from its piece's first byte
    places = np.repeat(vocabulary.starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])
    whole = vocabulary.spelt[places].tobytes()
    at = ends[np.cumsum([0] + [len(c) // 4 for c in coded])].tolist()
    texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text and ids (binary: little-endian unsigned 32 bits). Narrow: no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(model))
        for batch in slices(batches, "t", 2 << 20):
            ids = pa.array(encoder.encode(batch.column("t").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("t"), ids], ["id", "t", "ids"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, t string, ids binary").withColumnsRenamed({"id": id_col, "t": text_col})


def decode_documents(coded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and decoded, the text that its ids spell (none: empty)."""
    id_type = coded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in slices(batches, "ids", 2 << 20):
            texts = decode(vocabulary, [i or b"" for i in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "decoded"])

    plain = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return plain.mapInArrow(run, f"id {id_type}, decoded string").withColumnRenamed("id", id_col)


def restored_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids, decoded (from the ids alone) and restored (is it the text?), in one pass over the texts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(model))
        for batch in slices(batches, "t", 2 << 20):
            texts = batch.column("t").to_pylist()
            coded = encoder.encode(texts)
            back = decode(encoder.v, coded)
            same = [a == (b or "") for a, b in zip(back, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(coded, pa.binary()), pa.array(back, pa.string()), pa.array(same)], ["id", "ids", "decoded", "restored"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, ids binary, decoded string, restored boolean").withColumnRenamed("id", id_col)


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: number of pieces, a digest of the ids, and the decoded text's digest."""
    import public_tokenizers

    done = restored_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), F.length("decoded").cast("long").alias("decoded_chars"), "restored",
    )
