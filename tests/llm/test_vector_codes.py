import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from quireflow.llm import vector_codes as codes
from quireflow.llm.vector_codes import BallTree, op13_ball_codes, vector_codes


def lowest_nearest(entries, query):
    apart = [sum((int(a) - int(b)) ** 2 for a, b in zip(e, query, strict=True)) for e in entries]
    return apart.index(min(apart)), min(apart)


@pytest.mark.parametrize("leaf", [1, 4, 16])
@pytest.mark.parametrize("spread", [1, 3, 500, 1 << 27, 1 << 40])
@pytest.mark.parametrize("n", [1, 2, 60, 256])
def test_tree_finds_the_lowest_of_the_nearest(leaf, spread, n):
    r = np.random.default_rng(n)
    entries = r.integers(-spread, spread + 1, size=(n, 4))
    queries = np.concatenate([r.integers(-2 * spread, 2 * spread + 1, size=(60, 4)), entries[:20]])
    if 16 * (3 * spread) ** 2 >= 1 << 63:  # distances have to fit into 64 bits
        entries, queries = entries >> 12, queries >> 12
    found, apart = BallTree(entries, leaf).nearest(queries)
    assert list(zip(found.tolist(), apart.tolist(), strict=True)) == [lowest_nearest(entries, q) for q in queries]


def test_a_ball_is_visited_at_an_equal_bound():
    # the query is as far from entry 0 as from entry 1, and their balls touch there
    for shift in range(-3, 4):
        entries = np.array([[5 + shift], [-5 + shift], [6 + shift], [-6 + shift]])
        assert BallTree(entries, 1).nearest(np.array([[shift]]))[0].tolist() == [0]


def test_balls_rule_entries_out(monkeypatch):
    r = np.random.default_rng(0)
    entries = np.concatenate([r.integers(-5, 6, size=(16, 4)) + 1000 * k for k in range(16)])
    tree, seen = BallTree(entries), []
    real = codes._squared
    monkeypatch.setattr(codes, "_squared", lambda q, e, b: seen.append(len(q) * len(e)) or real(q, e, b))
    tree.nearest(entries)
    assert sum(seen[1:]) == 16 * len(entries)  # one ball of 16 each; the first call is the centres'


def brute(rows, scale=1024, parts=4, entries=256, rounds=4):
    """The contract in plain loops over (id, vector, label)."""
    kept = [(i, [math.floor(scale * float(c)) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = len(kept[0][1]) // parts
    cut = lambda x: [x[p * width : (p + 1) * width] for p in range(parts)]
    seeds = sorted((i, x) for i, x, _ in kept if i is not None)[:entries]
    books = [[cut(x)[p] for _, x in seeds] for p in range(parts)]

    def assigned():
        out = []
        for p in range(parts):
            book = np.array(books[p])
            apart = ((np.array([cut(x)[p] for _, x, _ in kept])[:, None, :] - book[None]) ** 2).sum(axis=2)
            out.append((apart.argmin(axis=1), apart.min(axis=1)))
        return out

    for _ in range(rounds):
        for p, (entry, _) in enumerate(assigned()):
            for e in set(entry.tolist()):
                mine = [cut(x)[p] for (_, x, _), at in zip(kept, entry, strict=True) if at == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    last = assigned()
    error = sum(apart for _, apart in last)
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, error, strict=True):
        by_label[label] += int(e)
    sha = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted((i is not None, i, "".join(f"{entry[k]:02x}" for entry, _ in last), int(error[k]), by_label[label], sha) for k, (i, _, label) in enumerate(kept))


def rows_of(df):
    return sorted((r.vec_id is not None, r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_loops(spark, sf):
    source = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")
    want = brute(list(zip(*(source[c].to_pylist() for c in ("vec_id", "embedding", "label")), strict=True)))
    assert rows_of(op13_ball_codes(spark, f"/root/testdata/{sf}")) == want


KIND = "vec_id long, embedding array<double>, label int, code string, x int"


def test_odd_rows(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(int(i), [float(v) for v in r.normal(size=8)], int(i) % 5 if i % 7 else None) for i in range(120)]
    rows += [(200, None, 1), (201, [None] * 8, 1), (202, [float("nan")] * 8, 2), (203, [float("-inf")] + [0.0] * 7, None), (None, rows[4][1], None), rows[5], rows[5], (6, [9.0] * 8, 77), (300, [1e6] * 8, 78)]
    vectors = spark.createDataFrame([(*row, "clash", 3) for row in rows], KIND).repartition(5)
    for one_in in (1, 4, 10_000):  # all labels by shuffle, some, all by broadcast
        monkeypatch.setattr(codes, "with_label_error", lambda df, f=codes.with_label_error, n=one_in: f(df, n))
        got, books = vector_codes(vectors, entries=9)
        assert rows_of(got) == brute(rows, entries=9)
        assert [len(b) for b in books.books] == [9] * 4
        monkeypatch.undo()


def test_few_rows_and_none(spark):
    rows = [(3, [0.1, 0.2, 0.3, 0.4], 1), (1, [0.5, 0.6, -0.7, 0.8], 1)]
    vectors = spark.createDataFrame([(*row, "", 0) for row in rows], KIND)
    got, books = vector_codes(vectors)
    assert rows_of(got) == brute(rows) and [len(b) for b in books.books] == [2] * 4
    got, books = vector_codes(vectors.where("vec_id < 0"))
    assert got.collect() == [] and books.books == []
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_parts_have_to_be_equal(spark):
    with pytest.raises(ValueError, match="4 equal parts"):
        vector_codes(spark.createDataFrame([(1, [0.0] * 6, 1, "", 0)], KIND))
