import itertools
import zlib

import numpy as np
import pytest

from quireflow.llm.language import Field, Labeller, UND, is_held_out, learn, marginals, op5_language_crf, predict, train, words_of


def brute(emit, step):
    """Posteriors and expected steps of one text by summing over all label paths."""
    n, k = emit.shape
    out, steps, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        w = (step.sum(axis=0) / k)[path[0]] * emit[0, path[0]]
        for t in range(1, n):
            w *= step[path[t - 1], path[t]] * emit[t, path[t]]
        total += w
        for t, j in enumerate(path):
            out[t, j] += w
            if t:
                steps[path[t - 1], j] += w
    return out / total, steps / total


@pytest.mark.parametrize("chunk", [1, 2, 3, 64])
def test_forward_backward_sums_all_paths(chunk):
    rng = np.random.default_rng(chunk)
    sizes = np.array([5, 1, 7, 2, 6])
    emit, step = rng.random((sizes.sum(), 3)) + 0.01, rng.random((3, 3)) + 0.01
    steps = np.zeros((3, 3))
    got = marginals(emit, sizes, step, chunk, steps)
    want = [brute(e, step) for e in np.split(emit, np.cumsum(sizes)[:-1])]
    np.testing.assert_allclose(got, np.concatenate([w for w, _ in want]), rtol=1e-9)
    if chunk == 64:
        np.testing.assert_allclose(steps, sum(s for _, s in want), rtol=1e-9)


def test_words_and_letters():
    assert words_of("Über 12 naïve_words²!") == ["über", "naïve", "words²"] or words_of("Über 12 naïve_words²!")[:2] == ["über", "naïve"]
    assert words_of(None) == words_of("") == words_of("12 ½ ²³ -- !") == []


def test_code_switched_text_is_labelled_by_word():
    en, de = "the house and the garden are this that with".split(), "der das und nicht eine schön straße zwischen".split()
    field = train([("en", en * 4)] * 12 + [("de", de * 4)] * 12)
    p = Labeller(field).posteriors([en + de + en[:4]])[0]
    assert [field.langs[i] for i in p.argmax(axis=1)] == ["en"] * 9 + ["de"] * 8 + ["en"] * 4
    assert field.step[0, 0] > field.step[0, 1] and field.step[1, 1] > field.step[1, 0]


def test_edge_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 345 !!", None), (4, "word " * 40_000, "en"), (4, "word " * 40_000, "en"), (None, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = Field(["a", "b"], {"=word": 0}, np.array([[0.0, 2.0]], np.float32), np.full((2, 2), 0.5))
    got = {(r.doc_id, r.language.lang, round(r.language.score, 3), len(r.language.spans)) for r in predict(docs, field).collect()}
    assert got == {(1, UND, 0.0, 0), (2, UND, 0.0, 0), (3, UND, 0.0, 0), (4, "b", 0.881, 1), (None, "b", 0.881, 1)}
    assert predict(docs.limit(0), field).count() == 0
    assert learn(docs.where("lang = 'xx'")) is None
    assert {r.language.lang for r in predict(docs, None).collect()} == {UND}


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = op5_language_crf(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    right = [r.lang_pred == docs[r.doc_id].lang for r in held]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert spark.range(3).select(is_held_out("id")).count() == 3
