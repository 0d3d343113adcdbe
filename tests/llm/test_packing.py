import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quireflow.llm.packing import ChunkEncoder, cut, hilbert_keys, pack_documents, pack_query

ENCODER = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.text(alphabet=st.sampled_from(" \n\t\r\x0b\x0c\x1c\x85\xa0 aB1é漢'.-<|>st😀"), max_size=40) | st.text(max_size=60))
@example("a <|endoftext|> b<|endoftext|>")
@example("  two  spaces \n\n x ")
@settings(max_examples=500, deadline=None)
def test_ids_equal_the_tokenizer(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 70), max_size=30))
def test_cut_covers_every_id_without_padding(sizes):
    pieces, at = defaultdict(list), defaultdict(int)
    for doc, start, length, sequence, offset in cut(enumerate(sizes), 16):
        assert start == at[doc] and length > 0
        at[doc] += length
        pieces[sequence].append((offset, length))
    assert [at[i] for i in range(len(sizes))] == sizes
    for parts in pieces.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 16 and ends & (ends - 1) == 0


def test_hilbert_curve_visits_neighbours():
    side = 8
    grid = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    keys = hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(side**3))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_documents_are_whole(spark):
    rows = [(i, f"Text number {i} " * (i * 7 % 90), i) for i in range(200)] + [(500, None, 0), (501, "", 0), (502, "a b\n" * 20_000, 0), (503, "same text", 0), (504, "same text", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    texts = {r[0]: r[1] or "" for r in rows}
    got = defaultdict(list)
    lengths = defaultdict(int)
    for r in pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect():
        got[r.doc_id].append((r.start, bytes(r.piece), r.doc_tokens))
        assert len(r.piece) == 4 * r.length
        lengths[r.sequence_id] += r.length
    assert got.keys() == texts.keys()
    for i, parts in got.items():
        ids = np.frombuffer(b"".join(p for _, p, _ in sorted(parts)), "<u4").tolist()
        assert ids == TOKENIZER.encode(texts[i], add_special_tokens=False).ids + [1]
        assert {n for *_, n in parts} == {len(ids)}
    assert all(n <= 2048 and n & (n - 1) == 0 for n in lengths.values())
    assert pack_documents(docs.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 0


def test_query_digest(spark):
    row = pack_query(spark.createDataFrame([(7, "hello world")], "doc_id long, text string")).orderBy("start").collect()
    ids = np.array(TOKENIZER.encode("hello world", add_special_tokens=False).ids + [1], "<u4")
    assert sum(r.length for r in row) == len(ids)
    assert row[0].ids_crc32 == zlib.crc32(ids[: row[0].length].tobytes())


def test_capacity_is_a_power_of_two(spark):
    with pytest.raises(ValueError):
        pack_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "x", capacity=100)


def test_ids_of_a_whole_table_equal_the_tokenizer():
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()]
    encoder = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for at in range(0, len(texts), 100):
        for text, want in zip(texts[at : at + 100], TOKENIZER.encode_batch(texts[at : at + 100], add_special_tokens=False), strict=False):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want.ids
