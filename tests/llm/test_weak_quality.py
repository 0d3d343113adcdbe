import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from quireflow.llm import weak_quality
from quireflow.llm.weak_quality import BUCKETS, classify, fit_labellers, fit_scorer, hashed, op9_weak_quality, votes


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.95, 0.8, 0.7, 0.9]
    counts: dict[str, int] = {}
    for good in truth:
        p = "".join("." if rng.random() < 0.2 else "+" if good == (rng.random() < a) else "-" for a in accuracy)
        counts[p] = counts.get(p, 0) + 1
    prior, rates, posterior = fit_labellers(counts)
    assert abs(prior - 0.7) < 0.03
    for j, a in enumerate(accuracy):
        assert abs(rates[j, 1, 2] / (rates[j, 1, 0] + rates[j, 1, 2]) - a) < 0.03
    assert posterior["++++"] > 0.99 and posterior["----"] < 0.01
    assert fit_labellers({}) [2] == {}


def test_hashed_features_are_shares():
    at, value = hashed("The the cat 12 %%%")
    assert abs(value.sum() - 1) < 1e-12 and at.max() < BUCKETS and (np.diff(at) > 0).all()
    assert len(hashed(None)[0]) == len(hashed(" \n")[0]) == 0
    assert not fit_scorer([]).any()


def test_votes_of_empty_texts():
    assert votes(None) == votes("") == votes(" \n ") == "-" + "." * 7


def test_edge_rows(spark):
    rows = [(1, None, 0.1), (2, "", 0.2), (3, "word " * 50_000, 0.3), (3, "word " * 50_000, 0.3), (None, "The cat sat.", 0.4)]
    got = classify(spark.createDataFrame(rows, "doc_id long, text string, score double")).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    assert classify(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_agrees_with_labels(spark):
    got = {r.doc_id: r for r in op9_weak_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good, bad = ([got[r.doc_id].score for r in labels if r.quality == q] for q in (1, 0))
    wins = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert wins > 0.95
    assert np.mean([g >= 0.5 for g in good]) > 0.97
    assert np.mean([b < 0.5 for b in bad]) > 0.8


def slow_posteriors(cast, rounds=200):
    """Expectation-maximisation document by document, in plain loops."""
    good = [1 / (1 + math.exp(-1.5 * sum({"+": 1, "-": -1, ".": 0}[c] for c in v))) for v in cast]
    n = len(cast)
    for _ in range(rounds):
        prior = (sum(good) + 1) / (n + 2)
        rate = []
        for j in range(len(cast[0])):
            count = {k: {c: 0.5 for c in "-.+"} for k in (0, 1)}
            for g, v in zip(good, cast, strict=True):
                count[1][v[j]] += g
                count[0][v[j]] += 1 - g
            rate.append({k: {c: x / sum(count[k].values()) for c, x in count[k].items()} for k in (0, 1)})
        new = []
        for v in cast:
            one = math.log(prior) + sum(math.log(rate[j][1][c]) for j, c in enumerate(v))
            none = math.log(1 - prior) + sum(math.log(rate[j][0][c]) for j, c in enumerate(v))
            new.append(1 / (1 + math.exp(min(500, max(-500, none - one)))))
        if max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-9:
            return good
        good = new
    return good


def slow_scores(texts, soft, rounds=60, rate=0.5):
    """The scorer in dictionaries, a document at a time."""
    rows = [dict(zip(*(x.tolist() for x in hashed(t)), strict=True)) for t in texts]
    share = min(0.98, max(0.02, sum(soft) / len(soft)))
    weigh = [(y / share + (1 - y) / (1 - share)) / 2 for y in soft]
    weight, seen = {"bias": 0.0}, {}
    score = lambda row: weight["bias"] + sum(10 * v * weight.get(a, 0.0) for a, v in row.items())
    for _ in range(rounds):
        grad = {"bias": -1e-3 * weight["bias"]} | {a: -1e-3 * w for a, w in weight.items() if a != "bias"}
        for row, y, m in zip(rows, soft, weigh, strict=True):
            error = (y - 1 / (1 + math.exp(-score(row)))) * m
            grad["bias"] += error
            for a, v in row.items():
                grad[a] = grad.get(a, 0.0) + 10 * v * error
        for a, g in grad.items():
            seen[a] = seen.get(a, 1e-8) + g * g
            weight[a] = weight.get(a, 0.0) + rate * g / math.sqrt(seen[a])
    return [1 / (1 + math.exp(-score(row))) for row in rows]


def test_query_against_brute_force(spark):
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    got = {r.doc_id: r for r in op9_weak_quality(spark, "/root/testdata/sf0.001").collect()}
    cast = [votes(d["text"]) for d in docs]
    soft = slow_posteriors(cast)
    scores = slow_scores([d["text"] for d in docs], soft)
    for d, v, p, s in zip(docs, cast, soft, scores, strict=True):
        r = got[d["doc_id"]]
        assert r.votes == v and r.posterior == pytest.approx(p, abs=1e-6) and r.score == pytest.approx(s, abs=1e-4)
        assert r.kept == (r.score >= 0.5) == bool(r.label)


def test_other_columns_do_not_disturb(spark):
    rows = [(1, "The cat sat on the mat.", "a", "b", "c")]
    plain = classify(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).first()
    assert classify(spark.createDataFrame(rows, "doc_id long, text string, votes string, id string, t string")).first() == plain


def test_long_documents_are_thinned_for_fitting_alone():
    at, value = np.arange(0, 9000, 2), np.arange(4500.0)
    some, values = weak_quality.thinned(at, value, 100)
    assert len(some) == 100 == len(set(some.tolist())) and some[0] == 0 and some[-1] == at[-1] and (values * 2 == some).all()
    assert weak_quality.thinned(at, value, 4500)[0] is at
