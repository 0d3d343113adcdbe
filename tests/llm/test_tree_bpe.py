import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quireflow.llm.tree_bpe import TreeEncoder, coded_documents, op11_tree_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
CODER = TreeEncoder(PATH)
WHOLE = Tokenizer.from_file(PATH)
WHOLE.no_truncation()
WHOLE.no_padding()


def ids_of(coded):
    return np.frombuffer(coded, "<u4").tolist()


def library(text):
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    return ids, WHOLE.decode(ids, skip_special_tokens=False)


def held_against_library(text, coder=CODER):
    coded = coder.encode(text)
    want = library(text)
    assert ids_of(coded) == want[0], repr(text)[:200]
    assert coder.decode([coded]) == [want[1]]


@pytest.mark.parametrize("leaf", [1, 2, 3, 16])
@pytest.mark.parametrize("letters", ["a", "ab", "the", "ing", "esrtan", "=-", "éa", "ßΣİ"])
def test_long_unsplit_words(leaf, letters):
    coder, chance = TreeEncoder(PATH, leaf), random.Random(leaf)
    for n in (1, 2, 3, 5, 17, 33, 100, 700):
        held_against_library("".join(chance.choice(letters) for _ in range(n)), coder)


def test_windows_grow_to_the_whole_word():
    for n in (64, 1000, 5000):
        held_against_library("a" * n)
        held_against_library("=" * n + "!" * n)


@given(st.text(max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(text):
    held_against_library(text)


@given(st.lists(st.sampled_from([" ", "\t", "\x1c", "\x85", " ", "it's", "'S", "they'LL", "don't", "<|endoftext|>", "<|startoftext|>", "<|", "x1234", "½²", "Ἄ", "é", "ǅ", "ΟΔΟΣ", "İ", "漢字", "😀", "</w>", "naïve", "ﬁ", "​", "́"]), max_size=12))
@settings(max_examples=400, deadline=None)
def test_joined_oddities(parts):
    held_against_library("".join(parts))


def test_every_character_by_itself_and_between_letters():
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for a in range(0, 0x3000):
        held_against_library(f"a{chr(points[a])}b")
    for a in range(0x3000, len(points), 997):
        held_against_library(f"a{chr(points[a])}b")


def test_memory_of_two_halves_changes_nothing(monkeypatch):
    from quireflow.llm import tree_bpe

    texts = [f"word{i % 7} and w{i}  x{i % 3}." for i in range(60)]
    want = [CODER.encode(t) for t in texts]
    monkeypatch.setattr(tree_bpe, "MEMORY", 5)
    small = TreeEncoder(PATH)
    assert [small.encode(t) for t in texts] == want


def test_leaves_dealt_to_tasks(spark):
    chance = random.Random(5)
    run = lambda n, letters: "".join(chance.choice(letters) for _ in range(n))
    texts = [None, "", " \t", "plain words", run(900, "abc"), "a " + run(700, "the") + " b <|endoftext|>" + run(300, "=+") + " c", "x" * 400 + "<|startoftext|>" + "y" * 399, run(401, "ing"), "1" * 500, "end " + run(250, "é") + "'s"]
    rows = [(i // 2 if i else None, t, i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = coded_documents(docs, PATH, long=200, dealt=50).collect()
    assert sorted((r.doc_id is not None, r.doc_id, bytes(r.ids), r.decoded) for r in got) == sorted(
        (r[0] is not None, r[0], np.array(library(r[1])[0], "<u4").tobytes(), library(r[1])[1]) for r in rows
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert coded_documents(docs, PATH).collect() == []


def test_query_equals_the_library(spark):
    got = {r.doc_id: r for r in op11_tree_bpe(spark, "/root/testdata/sf0.01").collect()}
    source = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    assert len(got) == len(source)
    for row in source:
        ids, back = library(row["text"])
        r = got[row["doc_id"]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
