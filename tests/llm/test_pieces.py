import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quireflow.llm import pieces
from quireflow.llm.pieces import MARK, Encoder, Vocabulary, decode, decode_documents, encode_documents, op7_piece_viterbi, restored_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")
V = Vocabulary(PATH)


LONGEST = max(map(len, V.ids))


def ids_of(coded):
    return np.frombuffer(coded, "<u4").tolist()


def score_of(ids):
    return sum(V.scores.get(V.pieces[i], 0.0) for i in ids)


def brute(text):
    """Best score over the whole marked text at once, without parting it into words or sharing prefixes."""
    marked = MARK + text.replace(" ", MARK)
    best = [0.0]
    for end in range(1, len(marked) + 1):
        best.append(max(best[s] + v for s in range(max(0, end - LONGEST), end) if (v := V.scores.get(marked[s:end], V.unknown_score if s == end - 1 else None)) is not None))
    return best[-1]


def test_no_piece_crosses_a_word():
    assert not any(MARK in p.lstrip(MARK) for p in V.ids)


@given(st.lists(st.text(alphabet="abehlorst é漢  ,.", max_size=24), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_best_score_and_round_trip(texts):
    for text, ids in zip(texts, Encoder(V).encode(texts), strict=True):
        assert decode(V, [ids]) == [text]
        unknown = sum(c not in V.scores for c in text.replace(" ", MARK))
        assert score_of(ids_of(ids)) + unknown * V.unknown_score == (pytest.approx(brute(text)) if text else 0)


def test_shared_prefixes_do_not_change_results():
    words = [MARK + w for w in ("the", "then", "thence", "there", "tree", "trees", "treatment", "a", "an", "and")]
    assert Encoder(V).search(sorted(words)) == [Encoder(V).search([w])[0] for w in sorted(words)]


def test_memory_of_two_halves_changes_nothing(monkeypatch):
    texts = [f"word{i % 7} and w{i}  x{i % 3}." for i in range(60)]
    want = Encoder(V).encode(texts)
    monkeypatch.setattr(pieces, "MEMORY", 5)
    small = Encoder(V)
    assert [small.encode([t])[0] for t in texts] == want


@given(st.text(max_size=40).filter(lambda t: MARK not in t))
@settings(max_examples=200, deadline=None)
def test_any_text_survives(text):
    assert decode(V, Encoder(V).encode([text])) == [text]


def test_library_reads_the_ids_and_scores_no_better():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [r["text"] for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist() if r["text"] and "\n" not in r["text"]]
    assert len(texts) > 20
    for text, coded in zip(texts, Encoder(V).encode(texts), strict=True):
        ids = ids_of(coded)
        assert sp.decode(ids) == text
        assert score_of(ids) >= score_of(sp.encode(text)) - 1e-3


def test_whole_documents_against_a_full_search():
    texts = [r["text"] for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist() if r["text"] and len(r["text"]) < 3000][:40]
    for text, coded in zip(texts, Encoder(V).encode(texts), strict=True):
        unknown = sum(c not in V.scores for c in text.replace(" ", MARK))
        assert score_of(ids_of(coded)) + unknown * V.unknown_score == pytest.approx(brute(text))


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "long word " * 20_000, "c"), (3, "same", "d"), (3, "same", "d"), (4, f"a{MARK}b", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = [(1, "", True), (2, "", True), (3, "long word " * 20_000, True), (3, "same", True), (3, "same", True), (4, "a b", False)]
    assert sorted((r.doc_id, r.decoded, r.restored) for r in restored_documents(docs, PATH).collect()) == want
    assert sorted((r.doc_id, r.decoded) for r in decode_documents(encode_documents(docs, PATH), PATH).collect()) == [w[:2] for w in want]
    assert restored_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query_restores_all(spark):
    got = op7_piece_viterbi(spark, "/root/testdata/sf0.001")
    assert got.where("restored").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
