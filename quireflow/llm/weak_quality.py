"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over the counts
of vote patterns (of all documents) estimates how each labeller votes on good and on bad documents, and with that the
share of good ones. The patterns' posteriors are the soft labels of a linear scorer over hashed words and word
shapes, fitted on a bounded sample of documents and applied to all of them.

Edge cases: null and empty texts have no words, so only the length labeller votes, and no features, so the scorer
falls back to its bias; an empty table gives an empty result; repeated rows are judged one by one and all count;
texts of any length are read whole; a score of just 0.5 counts as good; other columns are left alone. There are at most 3**8 vote patterns.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality_rules
from .common import lowered_words, slices, stored, table

BUCKETS = 1 << 14
#: Documents the scorer is fitted on, about; the bound is twice that.
SAMPLE_DOCS = 3000
#: Features of a document that the scorer is fitted on, at most: with the documents' bound, what reaches the driver is bounded.
SAMPLE_ENTRIES = 2048
ROUNDS, RATE = 60, 0.5
SYMBOLS = b"#*$%&|<>"
STOP_WORDS = frozenset(w.encode() for w in quality_rules.STOP_WORDS)
#: Bytes of a word's shape: letters, digits, white space, each other ASCII byte as itself.
_SHAPE = bytes(97 if 65 <= b <= 90 or 97 <= b <= 122 or b > 127 else 48 if 48 <= b <= 57 else b for b in range(256))
GOOD, BAD, NONE = "+", "-", "."


def _vote(value: float, bad_below: float | None, good: tuple[float, float], bad_above: float | None) -> str:
    if (bad_below is not None and value < bad_below) or (bad_above is not None and value > bad_above):
        return BAD
    return GOOD if good[0] <= value <= good[1] else NONE


def votes(text: str | None) -> str:
    """A character per labeller: length, symbols, stop words, word length, sentence ends, variety, most frequent word, repeated lines."""
    words = lowered_words(text)
    n = len(words)
    length = _vote(n, 2, (60, float("inf")), None)
    if not n:
        return length + NONE * 7
    raw = (text or "").encode("utf-8", "surrogatepass")
    chars = sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(x.rstrip()[-1:] in b".!?:" for x in lines) / len(lines)
    return (
        length
        + _vote(sum(raw.count(s) for s in SYMBOLS) / chars, None, (0, 0.01), 0.05)
        + _vote(sum(w in STOP_WORDS for w in words) / n, 0.06, (0.12, 1), None)
        + _vote(chars / n, 2.5, (3.5, 7.5), 9)
        + _vote(ends, 0.3, (0.7, 1), None)
        + _vote(len(set(words)) / n, 0.05, (0.25, 1), None)
        + _vote(max(Counter(words).values()) / n if n >= 8 else 0.2, None, (0, 0.15), 0.3)
        + _vote(1 - len(set(lines)) / len(lines), None, (0, 0.1), 0.4)
    )


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights (summing to one) of a whole text's words and word shapes."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, shapes = lowered_words(text), raw.translate(_SHAPE).split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    crc = zlib.crc32
    half = BUCKETS // 2
    a = np.fromiter(map(crc, words), np.int64, len(words)) % half
    # a shape keeps its letters' number up to eight, so long runs share a bucket
    b = np.fromiter((crc(s[:8] + s[-2:]) for s in shapes), np.int64, len(shapes)) % half + half
    counts = np.bincount(np.concatenate([a, b]), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at] / (len(words) + len(shapes))


def fit_labellers(patterns: dict[str, int], rounds: int = 200) -> tuple[float, np.ndarray, dict[str, float]]:
    """(share of good, table[labeller, class, vote], posterior of good by pattern) from counts of vote patterns.

    Votes are independent given the class. The start is the majority of votes, which also settles which class is good.
    """
    names, n = sorted(patterns), np.array([patterns[p] for p in sorted(patterns)], float)
    if not names:
        return 0.5, np.zeros((0, 2, 3)), {}
    kind = np.array([[(BAD, NONE, GOOD).index(c) for c in p] for p in names])
    good = 1 / (1 + np.exp(-1.5 * (kind - 1).sum(axis=1)))
    for _ in range(rounds):
        both = np.stack([(1 - good) * n, good * n])
        prior = (both.sum(axis=1) + 1) / (n.sum() + 2)
        rates = np.stack([np.stack([np.bincount(kind[:, j], both[c], 3) for c in (0, 1)]) for j in range(kind.shape[1])]) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
        log = np.log(prior)[None] + sum(np.log(rates[j])[:, kind[:, j]].T for j in range(kind.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return float(prior[1]), rates, dict(zip(names, good.tolist(), strict=True))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Weights (last: bias) of a logistic scorer with soft labels; classes weigh alike."""
    weights, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    if not rows:
        return weights
    at, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]) * 10
    owner, y = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]), np.array([r[2] for r in rows])
    share = np.clip(y.mean(), 0.02, 0.98)
    importance = (y / share + (1 - y) / (1 - share)) / 2
    for _ in range(rounds):
        score = np.bincount(owner, weights[at] * value, len(rows)) + weights[-1]
        error = (y - 1 / (1 + np.exp(-score))) * importance
        grad = np.append(np.bincount(at, error[owner] * value, BUCKETS), error.sum()) - 1e-3 * weights
        seen += grad**2
        weights += rate * grad / np.sqrt(seen)
    return weights


def thinned(at: np.ndarray, value: np.ndarray, most: int = SAMPLE_ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """So many features of a long document, evenly from its buckets; all of them if it has no more. Scoring takes all features of all documents."""
    if len(at) <= most:
        return at, value
    some = np.linspace(0, len(at) - 1, most).astype(np.int64)
    return at[some], value[some]


def with_votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([votes(t) for t in batch.column("t").to_pylist()], pa.string())], ["id", "votes"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, votes string")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: id, votes, posterior (of the weak-label model) and score (of the scorer), both the chance of good."""
    spark = docs.sparkSession
    counts = stored(with_votes(docs, id_col, text_col), "votes").groupBy("votes").count()
    patterns = {r[0]: r[1] for r in counts.collect()}  # at most 3**8 rows
    _, _, posterior = fit_labellers(patterns)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    place = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    total = sum(patterns.values())

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            found = [(*thinned(*hashed(t)), posterior[votes(t)]) for t in batch.column("t").to_pylist()]
            columns = [pa.array([f[0].tolist() for f in found], pa.list_(pa.int32())), pa.array([f[1].tolist() for f in found], pa.list_(pa.float32())), pa.array([f[2] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["at", "value", "y"])

    chosen = plain.where(place < F.lit(min(1.0, sample_docs / max(1, total))))
    drawn = chosen.mapInArrow(sampled, "at array<int>, value array<float>, y double").limit(2 * sample_docs).toArrow() if total else None
    rows = []
    if drawn is not None:
        rows = [(np.array(a, np.int64), np.array(v, np.float64), y) for a, v, y in zip(*(drawn.column(c).to_pylist() for c in ("at", "value", "y")), strict=True)]
    shared = spark.sparkContext.broadcast((fit_scorer(sorted(rows, key=lambda r: (r[2], r[0].tolist()))), posterior))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, of = shared.value
        for batch in slices(batches, "t"):
            texts = batch.column("t").to_pylist()
            cast = [votes(t) for t in texts]
            raw = np.array([10 * (weights[a] * v).sum() + weights[-1] for a, v in map(hashed, texts)])
            scores = 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
            columns = [batch.column("id"), pa.array(cast, pa.string()), pa.array([of[c] for c in cast], pa.float64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "votes", "posterior", "score"])

    return plain.mapInArrow(run, f"id {id_type}, votes string, posterior double, score double").withColumnRenamed("id", id_col)


def op9_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: weak-label posterior, the scorer's score, and whether the document is kept (score at least 0.5)."""
    out = classify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "votes", "posterior", "score", (F.col("score") >= 0.5).cast("int").alias("label"), (F.col("score") >= 0.5).alias("kept"))
