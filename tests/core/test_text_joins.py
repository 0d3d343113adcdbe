import bisect
import random
import time

import pytest
from pyspark.sql import functions as F

from quireflow.operators import alignment
from quireflow.operators.alignment import aligned_readings, confusions, edit_script, script_sizes
from quireflow.operators.evaluation import prepared_truth
from quireflow.operators.linking import alike_names, link_alike
from quireflow.operators.tagging import expand_to_tokens


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_ranges_are_widened_as_by_all_pairs(spark):
    r = random.Random(3)
    tokens, spans = [], []
    for k in range(30):
        at = 0
        for _ in range(r.randrange(12)):
            at += r.randrange(3)
            end = at + r.randrange(1, 5)
            tokens.append((k, at, end, "x" * (end - at)))
            at = end
        spans += [(k, a, a + r.randrange(-1, 9), f"s{i}") for i in range(r.randrange(8)) for a in [r.randrange(-2, 30)]]
    want = []
    for k, a, b, name in spans:
        met = [(s, e) for kk, s, e, _ in tokens if kk == k and e > a and s < b]
        if met:
            want.append((k, a, b, name, min(met)[0], max(met)[1], min(met)[1] - min(met)[0]))
    got = expand_to_tokens(spark.createDataFrame(spans, "k int, start int, end int, name string"), spark.createDataFrame(tokens, "k int, tok_start int, tok_end int, token string"), ["k"])
    assert sorted((x.k, x.start, x.end, x.name, x.span_start, x.span_end, len(x.first)) for x in got.collect()) == sorted(want)


def test_one_region_of_many_tokens(spark):
    n = 100_000
    words = [f"w{i}" for i in range(n)]
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    marks = [(s + 1, 1 if i % 2 else len(words[i]) + 2) for i, s in enumerate(starts[:-2]) if i % 4 < 2]
    attrs = [("T", f"offset:{o}; length:{n_};") for o, n_ in marks]
    lines = spark.createDataFrame([("i", 0, 0, " ".join(words), attrs)], "image_name string, region_idx int, line_idx int, text string, attrs array<struct<tag:string,body:string>>")
    began = time.time()
    got = sorted((r.start, r.end, r.text) for r in prepared_truth(lines, ("T",))[1].collect())
    took = time.time() - began
    ends = [s + len(w) for s, w in zip(starts, words, strict=True)]
    want = []
    for o, n_ in marks:
        a, b = bisect.bisect_right(ends, o), bisect.bisect_left(starts, o + n_) - 1
        want.append((starts[a], ends[b], " ".join(words[a : b + 1])))
    assert got == sorted(want)
    assert took < 90  # all pairs would be five thousand million


@pytest.mark.parametrize("similarity", [0.5, 0.7, 0.8, 0.9, 1.0])
def test_alike_names_are_all_found(spark, similarity):
    r = random.Random(int(similarity * 10))
    word = lambda most: "".join(r.choice("abné ") for _ in range(r.randrange(1, most)))
    known = [word(16) for _ in range(120)] + ["a", "ab", "aaaaaaaaaa", "Bad Münster am Stein"]
    names = [word(16) for _ in range(60)] + known[:20] + [k[1:] + "b" for k in known[20:60] if len(k) > 1] + ["aaaaaaaaa", "Bad Munster a. Stein"]
    allowed = lambda a, b: int(max(len(a), len(b)) * round(1 - similarity, 9) + 1e-9)
    want = {(a, b, distance(a, b)) for a in names for b in known if distance(a, b) <= allowed(a, b)}
    got = alike_names(spark.createDataFrame([(n,) for n in [*names, None, ""]], "text string"), spark.createDataFrame([(n,) for n in [*known, None, ""]], "name string"), similarity)
    assert {(x.text, x.name, x.edits) for x in got.collect()} == want


def test_links_of_alike_names(spark):
    gazetteer = spark.createDataFrame([("Heidelberg", 0, 1), ("Heidelberg", 1, 2), ("Heidelburg", 0, 3), ("Rome", 0, 4)], "name string, rank int, geoname_id long")
    spans = spark.createDataFrame([(1, "Geo_Town", "Heidelberg"), (2, "Geo_Town", "Heidlberg"), (3, "Sex", "Rome"), (4, "Geo_Town", "Ro")], "k int, label string, text string")
    assert sorted((r.k, r.geoname_ids) for r in link_alike(spans, gazetteer).collect()) == [(1, [1, 2, 3]), (2, [1, 2, 3])]
    with pytest.raises(ValueError):
        alike_names(spans, gazetteer, 0.3)


@pytest.mark.parametrize("cells", [1, 30, 1 << 20])
def test_scripts_are_shortest_and_lead_from_one_to_the_other(monkeypatch, cells):
    monkeypatch.setattr(alignment, "CELLS", cells)
    r = random.Random(cells)
    for _ in range(150):
        a, b = ("".join(r.choice("abc😀") for _ in range(r.randrange(14))) for _ in range(2))
        script = edit_script(a, b)
        assert "".join(s["a"] for s in script) == a and "".join(s["b"] for s in script) == b
        assert sum(max(len(s["a"]), len(s["b"])) for s in script if s["op"] != "keep") == distance(a, b)
        assert all((s["a"] == s["b"]) == (s["op"] == "keep") and (len(s["a"]) == len(s["b"])) == (s["op"] in ("keep", "change")) for s in script)


def test_long_texts_are_halved():
    r = random.Random(1)
    a = "".join(r.choice("abcdefgh ") for _ in range(4000))
    b = "".join(c if r.random() > 0.1 else r.choice("xyz") for c in a)
    script = edit_script(a, b)
    assert "".join(s["b"] for s in script) == b and sum(max(len(s["a"]), len(s["b"])) for s in script if s["op"] != "keep") == sum(x != y for x, y in zip(a, b, strict=True))


def test_runs_side_by_side(spark):
    kind = "image string, region_idx int, text string"
    one = spark.createDataFrame([("i", 0, "Berl1n 1901"), ("i", 1, "same"), ("i", 2, None), ("j", 0, "")], kind)
    two = spark.createDataFrame([("i", 0, "Berlin 190l"), ("i", 1, "same"), ("k", 0, "ab")], kind)
    both = aligned_readings(one, two, ["image", "region_idx"])
    sizes = {(r.image, r.region_idx): (r.kept, r.changed, r.dropped, r.added, r.edits) for r in script_sizes(both, ["image", "region_idx"]).collect()}
    assert sizes == {("i", 0): (9, 2, 0, 0, 2), ("i", 1): (4, 0, 0, 0, 0), ("i", 2): (0, 0, 0, 0, 0), ("j", 0): (0, 0, 0, 0, 0), ("k", 0): (0, 0, 0, 2, 2)}
    assert sorted((r.a, r.b, r.n) for r in confusions(both).collect()) == [("", "a", 1), ("", "b", 1), ("1", "i", 1), ("1", "l", 1)]
    assert both.where(F.col("image") == "none").count() == 0
