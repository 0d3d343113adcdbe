import random

import numpy as np
import pytest
import xxhash

from quireflow.llm import simhash
from quireflow.llm.components import components
from quireflow.llm.common import lowered_words, stored
from quireflow.llm.simhash import WORDS, block_masks, fingerprint, fingerprint_links, grouped_sketches, near_duplicates, op3_simhash, sketch, sketch_links, sketch_radius, sketches


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_fingerprint(text):
    words = ("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in (None, "", " \n", "One", "one two three", "A b c d", "A b c d é f g", "x " * 900 + "y z " * 333):
        assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("n", [10, 20_000_000, 10**12])
def test_no_near_pair_misses_all_masks(n):
    masks, rng = block_masks(n, 4), random.Random(1)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("tile", [8, 4096])
def test_links_connect_what_brute_force_connects(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "SUB_TILE", 4)
    rng = random.Random(tile)
    fps = {0, 2**64 - 1}
    for _ in range(25):
        fps.add(a := rng.getrandbits(64))
        for _ in range(rng.choice([0, 1, 40])):
            a ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 5])))
            fps.add(a)
    signed = [int(x) for x in np.array(sorted(fps), np.uint64).view(np.int64)]
    got = fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, tile).collect()
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    linked = groups(signed, near)
    assert all(linked[r.a] == linked[r.b] for r in got)
    assert groups(signed, [(r.a, r.b) for r in got]) == groups(signed, near)
    assert len(got) < 40 * len(signed)


def test_many_fingerprints_in_one_group(spark):
    rng = np.random.default_rng(3)
    low = rng.choice(1 << 22, 30_000, replace=False)  # all agree on 42 bits, so they share buckets of several tiles
    fps = spark.createDataFrame([(int(x),) for x in low], "fp long")
    got = components(fingerprint_links(fps, 4, 4096), "a", "b").collect()
    root = {int(x): int(x) for x in low} | {r.node: r.root for r in got}
    for x in low[:300]:
        near = low[np.bitwise_count(low ^ x) <= 4]
        assert {root[int(y)] for y in near} == {root[int(x)]}


def test_components_on_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 301), (301, 300), (302, 302)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = groups({x for p in links for x in p}, links)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_edge_rows(spark):
    rows = [(5, None, "x"), (3, "", "x"), (9, "a b c d e f", "x"), (2, "A B C D E F", "x"), (2, "a b c d e f", "x"), (None, "q r s t u", "x"), (7, "word " * 30_000, "x")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (2, 2), (2, 2), (3, 3), (5, 3), (7, 7), (9, 2)]
    clash = near_duplicates(spark.createDataFrame([("b", "x y"), ("a", "x y")], "fp string, component_id string"), "fp", "component_id")
    assert clash.columns == ["fp", "fp_", "component_id"] and {r.component_id for r in clash.collect()} == {"a"}
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: slow_fingerprint(r.text) for r in docs if len(r.text) < 4000}
    fps |= {r.doc_id: fingerprint(r.text) for r in docs if r.doc_id not in fps}
    ids = sorted(fps)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = groups(ids, near)
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


def shingles(text):
    words = lowered_words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def sketch_groups(spark, texts):
    """The group of each (id, text): its smallest id."""
    coded = stored(sketches(spark.createDataFrame(texts, "doc_id long, text string")), "sketches")
    first = grouped_sketches(coded, "doc_id")
    of = {r.fp: r.first for r in first.collect()}
    return {r.doc_id: of[r.fp] for r in coded.selectExpr("doc_id", "xxhash64(words) AS fp").collect()}


def test_near_copies_of_real_texts_by_similarity(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect() if r.text and len(r.text.split()) > 30]
    rng, copies = random.Random(4), []
    for i, text in docs[:400]:
        words, rate = text.split(" "), rng.choice([0.005, 0.01, 0.015, 0.02, 0.025])
        copies.append((10**6 + i, " ".join(w[::-1] + "q" if rng.random() < rate else w for w in words)))
    rows = docs + copies
    group, sets = sketch_groups(spark, rows), {i: shingles(t) for i, t in rows}
    found = {low: [] for low in (0.95, 0.9, 0.85, 0.8)}
    for i, text in copies:
        alike = jaccard(sets[i], sets[i - 10**6])
        if alike >= 0.8 and text != dict(docs[:400])[i - 10**6]:
            found[next(low for low in found if alike >= low)].append(group[i] == group[i - 10**6])
    told = {low: (sum(hits), len(hits)) for low, hits in found.items()}
    assert all(n > 20 and hits >= 0.9 * n for hits, n in told.values()), told
    # pairs that the documents themselves hold, by shared shingles
    at = {}
    for i, _ in docs:
        for x in sets[i]:
            at.setdefault(x, []).append(i)
    met = {(a, b) for ids in at.values() if len(ids) < 200 for k, a in enumerate(ids) for b in ids[:k]}
    own = [group[a] == group[b] for a, b in met if 0.8 <= jaccard(sets[a], sets[b]) < 1]
    assert len(own) > 5 and sum(own) >= 0.9 * len(own)
    # and nothing is linked that is unlike: whoever is in a group has a partner there
    members = {}
    for i, g in group.items():
        members.setdefault(g, []).append(i)
    for ids in members.values():
        for i in ids if len(ids) > 1 else []:
            assert max(jaccard(sets[i], sets[j]) for j in ids if j != i) >= 0.65


@pytest.mark.parametrize("tile", [8, 4096])
def test_long_fingerprints_against_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "SUB_TILE", 4)
    rng = np.random.default_rng(tile)
    words = [rng.integers(-(2**62), 2**62, WORDS)]
    for _ in range(90):
        flips = np.packbits(rng.random((WORDS, 64)) < rng.choice([0.02, 0.12]), axis=1).view("<i8").reshape(-1)
        words.append(words[rng.integers(len(words))] ^ flips)
    bands = rng.integers(0, 2, (len(words), 3))
    rows = [(k, w.tolist(), b.tolist()) for k, (w, b) in enumerate(zip(words, bands, strict=True))]
    got = sketch_links(spark.createDataFrame(rows, "fp long, words array<long>, bands array<long>"), sketch_radius(), tile).collect()
    apart = lambda a, b: int(np.bitwise_count((words[a] ^ words[b]).view(np.uint64)).sum())
    near = [(a, b) for a in range(len(words)) for b in range(a) if apart(a, b) <= sketch_radius() and (bands[a] == bands[b]).any()]
    assert groups(range(len(words)), [(r.a, r.b) for r in got]) == groups(range(len(words)), near)


def test_sketch_of_odd_texts():
    for text in (None, "", " \n"):
        words, bands = sketch(text)
        assert not words.any() and not bands.any()
    assert all((a == b).all() for a, b in zip(sketch("A b\tC d e f"), sketch("a B c d E F"), strict=True))
    long = " ".join(f"w{i}" for i in range(20_000))
    assert all((a == b).all() for a, b in zip(sketch(long + " " + long), sketch(long + " " + long), strict=True)) and sketch(long)[0].any()
    assert 80 <= sketch_radius() <= 90 and sketch_radius(1.0) == 0
