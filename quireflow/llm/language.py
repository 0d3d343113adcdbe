"""Language identification by a linear-chain conditional random field over words.

Each word has affix, n-gram, shape and lexicon features; transitions between languages are learned from spliced
training segments, so code-switched text is labelled word by word. Marginals come from forward-backward over the whole
text: texts are cut into chunks, each chunk's step matrices are multiplied, the products are scanned per text, and
both passes then run over all chunks at once. That is exact, and as many array operations as a chunk has words.

Training uses a bounded sample: about ``sample_docs`` documents of a language, ``SEGMENTS`` segments each, drawn from
the whole text by hash. Prediction reads nothing but the text.

Edge cases: null texts and texts without a letter are ``und`` with score 0; ties go to the language first in order; an
empty table gives an empty result; without any labelled row every text is ``und``; repeated rows are labelled one by
one; texts of any length are labelled whole; other columns are left alone.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import free_name, slices, table

UND = "und"
#: Documents a language is learned from, segments a document gives, words a segment holds.
SAMPLE_DOCS, SEGMENTS, SEGMENT_WORDS = 150, 4, 48
#: Languages that are learned at most, the most frequent ones; labels beyond are taken for mistakes.
MOST_LANGUAGES = 64
LEXICON, CHUNK, MEMORY = 300, 256, 150_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if the text has no letter."""
    words = _WORD.findall((text or "").lower())
    if words and not words[0].isalpha() and not any(c.isalpha() for w in words for c in w):
        return []
    return words


def features(word: str) -> list[str]:
    """Affixes up to three characters, two- and three-grams with the word's ends, and its length class."""
    w = f"^{word}$"
    grams = [w[i : i + 2] for i in range(len(w) - 1)] + [w[i : i + 3] for i in range(len(w) - 2)]
    affixes = [f"<{word[:k]}" for k in (1, 2, 3)] + [f">{word[-k:]}" for k in (1, 2, 3)]
    return [*grams, *affixes, f"#{min(len(word), 12)}"]


@dataclass
class Field:
    """Weights: one row per known feature, one column per language; step[i, j]: from language i to j."""

    langs: list[str]
    rows: dict[str, int]
    weights: np.ndarray
    step: np.ndarray

    def rows_of(self, word: str) -> list[int]:
        get = self.rows.get
        return [r for f in (*features(word), f"={word}") if (r := get(f)) is not None]

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp of each word's scores, at most 1 a row."""
        lists = [self.rows_of(w) for w in words]
        out = np.zeros((len(words), len(self.langs)), np.float32)
        counts = np.array([len(x) for x in lists])
        if counts.sum():
            flat = np.fromiter((r for x in lists for r in x), np.int64, counts.sum())
            some = counts > 0
            out[some] = np.add.reduceat(self.weights[flat], np.r_[0, np.cumsum(counts[some])[:-1]], axis=0)
        return np.exp(out - out.max(axis=1, keepdims=True)) + np.float32(1e-12)


def _normed(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(emit: np.ndarray, sizes: np.ndarray, step: np.ndarray, chunk: int = CHUNK, steps: np.ndarray | None = None) -> np.ndarray:
    """Posterior of each word's language: emit has a row per word, texts one after the other with sizes (all > 0).

    steps, if given, gains the expected number of steps between languages inside chunks.
    """
    n_langs, step = emit.shape[1], step.astype(np.float64)
    per_doc = -(-sizes // chunk)
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    start = np.repeat(np.cumsum(sizes) - sizes, per_doc) + number * chunk
    length = np.minimum(chunk, np.repeat(sizes, per_doc) - number * chunk)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    active = np.searchsorted(-length, -np.arange(chunk), side="left")  # chunks longer than s come first
    product = np.broadcast_to(np.eye(n_langs), (len(doc), n_langs, n_langs)).copy()
    for s in range(int(length[0])):
        k = active[s]
        now = (product[:k] @ step) * emit[start[:k] + s][:, None, :]
        product[:k] = now / now.max(axis=(1, 2), keepdims=True)
    place = np.empty(len(order), np.int64)  # of each chunk, by text and number, among the sorted ones
    place[order] = np.arange(len(order))
    first = np.cumsum(per_doc) - per_doc
    before, after = np.full((len(doc), n_langs), 1 / n_langs), np.full((len(doc), n_langs), 1 / n_langs)
    for k in range(1, int(per_doc.max())):
        here = first[per_doc > k] + k
        before[place[here]] = _normed((before[place[here - 1]][:, None, :] @ product[place[here - 1]])[:, 0])
        more = per_doc > k
        here = (first + per_doc - 1 - k)[more]
        after[place[here]] = _normed((product[place[here + 1]] @ after[place[here + 1]][:, :, None])[:, :, 0])
    out = np.empty((len(emit), n_langs))
    for s in range(int(length[0])):
        k, at = active[s], start[: active[s]] + s
        before[:k] = _normed((before[:k] @ step) * emit[at])
        out[at] = before[:k]
    for s in range(int(length[0]) - 1, -1, -1):
        k, at = active[s], start[: active[s]] + s
        if steps is not None and s:
            joint = out[at - 1][:, :, None] * step * (after[:k] * emit[at])[:, None, :]
            steps += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        out[at] = _normed(out[at] * after[:k])
        after[:k] = _normed((after[:k] * emit[at]) @ step.T)
    return out


def train(segments: list[tuple[str, list[str]]], rounds: int = 25, rate: float = 0.3, seed: int = 5) -> Field | None:
    """Fits by adaptive gradient ascent on spliced sequences of labelled segments."""
    langs = sorted({lang for lang, _ in segments})
    if not langs:
        return None
    counts = {lang: Counter(w for a, words in segments if a == lang for w in words) for lang in langs}
    lexicon = {w for c in counts.values() for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]}
    types = sorted({w for _, words in segments for w in words})
    rows: dict[str, int] = {}
    lists = [[rows.setdefault(f, len(rows)) for f in (*features(w), *([f"={w}"] if w in lexicon else []))] for w in types]
    code, label = {w: i for i, w in enumerate(types)}, {lang: i for i, lang in enumerate(langs)}
    shuffled = sorted(segments)
    random.Random(seed).shuffle(shuffled)
    # neighbours in the shuffled order are spliced, so a sequence changes language now and then
    texts = [shuffled[i : i + 3] for i in range(0, len(shuffled), 3)]
    x = np.array([code[w] for t in texts for _, ws in t for w in ws])
    y = np.array([label[lang] for t in texts for lang, ws in t for _ in ws])
    sizes = np.array([sum(len(ws) for _, ws in t) for t in texts])
    feature, owner = np.array([r for a in lists for r in a]), np.repeat(np.arange(len(types)), [len(a) for a in lists])
    n = len(langs)
    field = Field(langs, rows, np.zeros((len(rows), n), np.float32), np.full((n, n), 1 / n))
    log_step, seen_w, seen_s = np.zeros((n, n)), np.full(field.weights.shape, 1e-6), np.full((n, n), 1e-6)
    ends = np.cumsum(sizes)
    inner = np.setdiff1d(np.arange(1, len(x)), ends)  # words with a word before them
    true_steps = np.zeros((n, n))
    np.add.at(true_steps, (y[inner - 1], y[inner]), 1)
    for _ in range(rounds):
        score = np.stack([np.bincount(owner, field.weights[feature, j], len(types)) for j in range(n)], axis=1)
        emit = np.exp(score - score.max(axis=1, keepdims=True))[x] + 1e-12
        expected = np.zeros((n, n))
        p = marginals(emit, sizes, field.step, int(sizes.max()), expected)
        diff = np.eye(n)[y] - p
        by_type = np.stack([np.bincount(x, diff[:, j], len(types)) for j in range(n)], axis=1)
        grad = np.stack([np.bincount(feature, by_type[owner, j], len(rows)) for j in range(n)], axis=1) - 0.05 * field.weights
        seen_w += grad**2
        field.weights += (rate * grad / np.sqrt(seen_w)).astype(np.float32)
        step_grad = true_steps - expected - 0.05 * log_step
        seen_s += step_grad**2
        log_step += rate * step_grad / np.sqrt(seen_s)
        field.step = np.exp(log_step - log_step.max())
    return field


class Labeller:
    """Labels texts with a field; distinct words' emissions are remembered."""

    def __init__(self, field: Field):
        self.field = field
        self._code: dict[str, int] = {}
        self._emit = np.zeros((0, len(field.langs)), np.float32)

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """A row per word, for each text's words."""
        new = sorted({w for t in texts for w in t if w not in self._code})
        if len(self._code) + len(new) > MEMORY:
            new = sorted({w for t in texts for w in t})
            self._code.clear()
            self._emit = self._emit[:0]
        if new:
            self._code.update((w, i) for i, w in enumerate(new, len(self._code)))
            self._emit = np.concatenate([self._emit, self.field.emissions(new)])
        sizes = np.array([len(t) for t in texts])
        some = sizes > 0
        if not some.any():
            return [np.zeros((0, len(self.field.langs)))] * len(texts)
        code = self._code
        flat = np.fromiter((code[w] for t in texts for w in t), np.int64, sizes.sum())
        out = marginals(self._emit[flat], sizes[some], self.field.step)
        return np.split(out, np.cumsum(sizes)[:-1])


def sample_segments(docs: DataFrame, text_col: str, lang_col: str, id_col: str, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, list[str]]]:
    """Labelled segments of about sample_docs documents of each language; only these reach the driver."""
    counts = docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(MOST_LANGUAGES).collect()
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for r in counts for v in (r[0], min(1.0, sample_docs / r[1]))])
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = docs.where(F.col(lang_col).isin([r[0] for r in counts]) & (place < share[F.col(lang_col)]))
    plain = chosen.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            out = []
            for i, lang, text in zip(*(batch.column(c).to_pylist() for c in ("id", "lang", "t")), strict=True):
                words = words_of(text)
                for k in range(min(SEGMENTS, -(-len(words) // SEGMENT_WORDS))):
                    at = zlib.crc32(f"{i}:{k}".encode()) % max(1, len(words) - SEGMENT_WORDS + 1)
                    out.append((f"{i}:{k}", lang, [w[:200] for w in words[at : at + SEGMENT_WORDS]]))
            if out:
                ids, langs, segments = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(langs), pa.array(segments, pa.list_(pa.string()))], ["id", "lang", "words"])

    rows = sorted(plain.mapInArrow(run, "id string, lang string, words array<string>").collect(), key=lambda r: (r.lang, zlib.crc32(r.id.encode()), r.id))
    taken: Counter = Counter()
    out = []
    for r in rows:  # the draw is about right; the bound is exact
        taken[r.lang] += 1
        if taken[r.lang] <= sample_docs * SEGMENTS:
            out.append((r.lang, list(r.words)))
    return out


def is_held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the ids; rows without an id are held out as well."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


_RESULT = "lang string, score double, spans array<struct<lang:string,first_word:int,n_words:int>>"


def predict(docs: DataFrame, field: Field | None, text_col: str = "text", out: str = "language") -> DataFrame:
    """The input with a struct (underscores are added to its name if the input has it): lang, score (mean posterior of that
    language), and spans, the runs of words with one language (lang, first word, words) in text order."""
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())])
    arrow = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])
    out = free_name(docs, out)
    rows = docs.withColumn(text_col, F.col(text_col).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded by the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value) if shared.value else None
        for batch in slices(batches, text_col, 4 << 20):
            texts = [words_of(t) if labeller else [] for t in batch.column(text_col).to_pylist()]
            found = labeller.posteriors(texts) if labeller else [()] * len(texts)
            done = []
            for p in found:
                if not len(p):
                    done.append({"lang": UND, "score": 0.0, "spans": []})
                    continue
                mean, best, langs = p.mean(axis=0), p.argmax(axis=1), labeller.field.langs
                cuts = np.r_[0, np.flatnonzero(np.diff(best)) + 1, len(best)].tolist()
                spans = [{"lang": langs[best[a]], "first_word": a, "n_words": b - a} for a, b in zip(cuts, cuts[1:], strict=False)]
                top = int(mean.argmax())
                done.append({"lang": langs[top], "score": float(min(1.0, mean[top])), "spans": spans})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, arrow)], [*batch.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, StructType.fromDDL(_RESULT))]))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Field | None:
    """A field learned from the documents that are not held out."""
    return train(sample_segments(docs.where(~is_held_out(id_col)), text_col, lang_col, id_col))


def op5_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: predicted language and the mean posterior of its words."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", is_held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.size("language.spans").cast("long").alias("n_spans"))
