import itertools
import random

import pytest
from pyspark.sql import functions as F

from quireflow.functions.geometry import parse_coords, resized
from quireflow.functions.text import ground_truth_name
from quireflow.operators.evaluation import assigned_errors, best_order, line_offsets, link_scores, prepared_truth, region_tag_scores, tag_scores
from quireflow.operators import metrics
from quireflow.operators.layout import average_iou, filter_masks, region_counts, region_pairs, region_scores
from quireflow.operators.metrics import cumulative_flushes, histogram, last_rows
from quireflow.operators.tagging import expand_to_tokens, rules, tokens_of, with_tags


@pytest.mark.parametrize(
    "truth, predicted, want",
    [
        ([("Lima", 7), ("Java", 8)], [("Lima", [7]), ("Java", [1, 8])], (2, 0, 100.0, 100.0, 100.0)),
        ([("Lima", None), ("Oslo", None), ("Java", 8), ("Rome", 9), ("Cork", 10)], [("Lima", [7]), ("Java", [8]), ("Rome", [9]), ("Cork", None)], (2, 1, 66.67, 100.0, 80.0)),
        ([(w, 5) for w in "Lima Oslo Java Rome".split()], [("Lima", [4]), ("Oslo", [5]), ("Java", [6, 5]), ("Rome", [])], (2, 2, 50.0, 100.0, 66.67)),
        ([("Lima", None)], [("Lima", [1])], (0, 0, None, None, None)),
    ],
)
def test_link_scores(spark, truth, predicted, want):
    g = spark.createDataFrame([("a", t, i) for t, i in truth], "image_name string, text string, geoname_id long")
    p = spark.createDataFrame([("a", t, i) for t, i in predicted], "image_name string, text string, geoname_ids array<long>")
    r = link_scores(g, p).first()
    assert (r.tp, r.fp, r.precision, r.recall, r.f1) == want and r.fn == 0 and r.valid == (want[2] is not None)


@pytest.mark.parametrize(
    "text, want",
    [
        ("Leg. 7.11.1888, det. 30.XII.1921; seen again IX.04", [("GatheringDate", 5, 9), ("GatheringDate", 21, 11), ("GatheringDate", 45, 5)]),
        ("found at 8°15'W and 101 ° 7'E", [("Geo_Longitude", 9, 6), ("Geo_Longitude", 20, 9)]),
        ("found at 8°15'N and 101 ° 7'S", [("Geo_Latitude", 9, 6), ("Geo_Latitude", 20, 9)]),
        ("see http://coll.EXAMPLE.org/u/0a9Zz1 or http://example.org/u/0a9Zz1", [("NURI", 4, 32)]),
        ("⚥, ♀♂", [("Sex", 0, 1), ("Sex", 3, 1), ("Sex", 4, 1)]),
        ("Paratypus! LECTOTYPE, a type\u00a0(syntypes)", [("Type", 0, 9), ("Type", 11, 9), ("Type", 24, 4), ("Type", 30, 8)]),
        ("Käfer 12..1999 größe 3.75 Übertype", [("GatheringDate", 6, 8), ("GatheringDate", 21, 4)]),
        ("", []),
        (None, []),
    ],
)
def test_tags(spark, text, want):
    tags = with_tags(spark.createDataFrame([(text,)], "text string")).first().tags
    assert [(s.label, s.start, s.end - s.start) for s in tags] == want
    assert all(s.text == text[s.start : s.end] for s in tags)


def test_tags_of_a_project(spark):
    table = rules("objects.example.net", "X_")
    df = with_tags(spark.createDataFrame([("http://objects.example.net/u/abcdef ♀",)], "text string"), table=table, labels=("X_NURI",))
    assert [(s.label, s.text) for s in df.first().tags] == [("X_NURI", "http://objects.example.net/u/abcdef")]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_tokens_and_widened_truth(spark):
    texts = spark.createDataFrame([("r", "Köln, 3°5'E  x")], "k string, text string")
    assert [(r.tok_start, r.tok_end, r.token) for r in tokens_of(texts, ["k"]).orderBy("tok_start").collect()] == [(0, 4, "Köln"), (4, 5, ","), (6, 7, "3"), (7, 8, "°"), (8, 11, "5'E"), (13, 14, "x")]
    attr = lambda tag, body: (tag, body)
    rows = [
        ("i", 0, 0, "Bad Ems", [attr("readingOrder", "index:0;"), attr("Geo_Town", "offset:1; length:4; Geonames:12;")]), ("i", 0, 1, "♂ leg.", [attr("Sex", "offset:0; length:1;"), attr("Other", "offset:0; length:1;"), attr("Sex", "length:1;")]),
        ("i", 1, 0, "", [attr("Sex", "offset:0; length:1;")]),
    ]
    lines = spark.createDataFrame(rows, "image_name string, region_idx int, line_idx int, text string, attrs array<struct<tag:string,body:string>>")
    joined, spans = prepared_truth(lines, ("Geo_Town", "Sex"))
    assert [(r.region_idx, r.text) for r in joined.collect()] == [(0, "Bad Ems\n\n♂ leg.")]
    assert sorted((r.label, r.start, r.end, r.text, r.geoname_id) for r in spans.collect()) == [("Geo_Town", 0, 7, "Bad Ems", 12), ("Sex", 9, 10, "♂", None)]


def test_every_region_against_the_first_true_one(spark):
    kind = "image_name string, region_idx int, start int, end int, label string"
    truth = spark.createDataFrame([("a", 2, 0, 1, "S"), ("a", 2, 3, 4, "T"), ("a", 5, 9, 10, "S"), ("b", 0, None, None, None)], kind)
    found = spark.createDataFrame([("a", 0, 0, 1, "S"), ("a", 0, 7, 8, "S"), ("a", 1, None, None, None), ("b", 0, 1, 2, "S"), ("c", 0, 1, 2, "S")], kind)
    got = {(r.image_name, r.region_idx): (r.tp, r.fp, r.fn) for r in region_tag_scores(truth, found).collect()}
    assert got == {("a", 0): (1, 1, 1), ("a", 1): (0, 0, 2), ("b", 0): (0, 1, 0)}


@pytest.mark.parametrize(
    "pairs, n_gt, n_pred, want",
    [([(0, 0, 0.8)], 1, 1, 0.8), ([(0, 0, 0.8)], 2, 2, 0.8), ([(0, 0, 0.8), (1, 0, 0.5)], 2, 1, 1.3 / 3), ([(0, 0, 0.6)], 1, 3, 0.2), ([], 0, 2, 0.0), ([], 1, 1, None)],
)
def test_average_iou(spark, pairs, n_gt, n_pred, want):
    p = spark.createDataFrame([("a", *x) for x in pairs], "image_name string, gt_idx int, pred_idx int, iou double")
    c = spark.createDataFrame([("a", n_gt, n_pred)], "image_name string, n_gt int, n_pred int")
    assert average_iou(p, c).first().avg_iou == (None if want is None else pytest.approx(want))


def test_boxes_overlap(spark):
    rows = [("a", 0, (0, 0, 10, 10)), ("a", 1, (50, 50, 5, 5))]
    kind = "image_name string, region_idx int, box struct<x:int,y:int,w:int,h:int>"
    g, p = spark.createDataFrame(rows, kind), spark.createDataFrame([("a", 0, (5, 0, 10, 10)), ("b", 0, (0, 0, 1, 1))], kind)
    assert [(r.gt_idx, r.pred_idx, round(r.iou, 6)) for r in region_pairs(g, p).collect()] == [(0, 0, round(50 / 150, 6))]
    assert {(r.image_name, r.n_gt, r.n_pred) for r in region_counts(g, p).collect()} == {("a", 2, 1), ("b", 0, 1)}


@pytest.mark.parametrize(
    "masks, want",
    [
        ([("A", 5, 5, 1, True)], ["A"]),
        ([("A", 50, 50, 2500, False), ("B", 50, 50, 2500, True), ("C", 50, 50, 2000, False), ("D", 10, 10, 100, False)], ["A"]),
        ([("E", 50, 50, 2000, False), ("F", 20, 20, 300, False)], ["E"]),
        ([("G", 20, 20, 390, False), ("H", 40, 40, 1600, False)], ["H", "G"]),
        ([("I", 0, 0, 0, False), ("J", 40, 40, 1600, False)], ["J"]),
    ],
)
def test_mask_filter(spark, masks, want):
    df = spark.createDataFrame([("i", i, 10_000, *m) for i, m in enumerate(masks)], "image_name string, mask_idx int, image_px int, name string, w int, h int, area long, has_holes boolean")
    assert [r.name for r in filter_masks(df).orderBy("region_idx").collect()] == want


def test_assignment_matches_all_permutations():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randrange(1, 6)
        cost = [[rng.randrange(4) for _ in range(n)] for _ in range(n)]
        want = min(itertools.permutations(range(n)), key=lambda p: (sum(cost[r][c] for c, r in enumerate(p)), p))
        assert best_order(cost) == list(want)


def test_assigned_errors(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(1, 5)))
    sides = {f"n{n}": ([word() for _ in range(n)], [word() for _ in range(n)]) for n in (1, 2, 3, 4, 5)}
    many = [(k, i, s, t) for k, (g, p) in sides.items() for s, ts in (("gt", g), ("pred", p)) for i, t in enumerate(ts)]
    got = assigned_errors(spark.createDataFrame(many, "image string, idx int, side string, text string"), "image").collect()
    for k, (g, p) in sides.items():
        edits = lambda a, b: spark.range(1).select(F.levenshtein(F.lit(a), F.lit(b))).first()[0]
        cost = [[edits(a, b) for b in g] for a in p]
        order = min(itertools.permutations(range(len(g))), key=lambda o: (sum(cost[r][c] for c, r in enumerate(o)), o))  # noqa: B023
        assert sorted((r.bb_index, r.cer) for r in got if r.image == k) == [(c, pytest.approx(cost[r][c] / len(g[c]))) for c, r in enumerate(order)]
    rows = [("a", 0, "gt", "abc"), ("a", 1, "gt", "xyz1"), ("a", 0, "pred", "xyz2"), ("a", 1, "pred", "abc"), ("b", 0, "gt", "x"), ("c", 0, "gt", ""), ("c", 0, "pred", "q")]
    got = assigned_errors(spark.createDataFrame(rows, "image string, idx int, side string, text string"), "image").collect()
    assert {(r.image, r.bb_index, r.cer) for r in got} == {("a", 0, 0.0), ("a", 1, 0.25), ("c", 0, None)}


@pytest.mark.parametrize("size, compat, want", [((1000, 800), False, (1000, 800)), ((3840, 2160), True, (1920, 1080)), ((1000, 4000), True, (7680, 1920)), ((1000, 4000), False, (480, 1920))])
def test_resize(spark, size, compat, want):
    r = spark.range(1).select(resized(F.lit(size[0]), F.lit(size[1]), compat=compat).alias("s")).first().s
    assert (r.w, r.h) == want


def test_names_points_offsets_and_tokens(spark):
    r = spark.createDataFrame([("jpg_1.jpg", " 1,2  3,4 ")], "n string, p string").select(ground_truth_name(F.col("n")).alias("a"), ground_truth_name(F.col("n"), True).alias("b"), parse_coords(F.col("p")).alias("p")).first()
    assert (r.a, r.b, [tuple(x) for x in r.p]) == ("jpg_1.xml", "xml_1.xml", [(1, 2), (3, 4)])
    lines = spark.createDataFrame([("r", 0, "Hanoi!"), ("r", 1, "♀ 8.II.1911")], "k string, i int, text string")
    assert [x.start for x in line_offsets(lines, ["k"], "i", "text").orderBy("i").collect()] == [0, 8]
    spans = spark.createDataFrame([("r", 2, 7)], "k string, start int, end int")
    tokens = spark.createDataFrame([("r", 0, 3), ("r", 4, 9), ("r", 10, 12)], "k string, tok_start int, tok_end int")
    assert [(x.span_start, x.span_end) for x in expand_to_tokens(spans, tokens, ["k"]).collect()] == [(0, 9)]


def test_null_spans_and_labels_do_not_count(spark):
    kind = "g int, start int, label string"
    truth, found = spark.createDataFrame([(1, 0, "S"), (1, None, "S")], kind), spark.createDataFrame([(1, 0, "S"), (1, 5, None)], kind)
    r = tag_scores(truth, found, ["g", "start", "label"], ["g"]).first()
    assert (r.tp, r.fp, r.fn) == (1, 0, 0)
    t = spark.createDataFrame([("a", "x", "T", 1), ("a", "y", "S", 2)], "image_name string, text string, label string, geoname_id long")
    p = spark.createDataFrame([("a", "x", "T", [1]), ("a", "y", "S", [3])], "image_name string, text string, label string, geoname_ids array<long>")
    assert [(x.tp, x.fp) for x in link_scores(t, p, labels=("T",)).collect()] == [(1, 0)]


def test_scores_of_one_table_equal_those_of_two(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(9), i, tuple(rng.randrange(1, 20) for _ in range(4)), rng.random() < 0.6, rng.random() < 0.5) for i in range(80)]
    r = spark.createDataFrame(rows, "image_name int, region_idx int, box struct<x:int,y:int,w:int,h:int>, g boolean, p boolean")
    g, p = r.where("g"), r.where("p")
    of = lambda df: sorted((x.image_name, x.n_gt, x.n_pred, None if x.avg_iou is None else round(x.avg_iou, 9)) for x in df.collect())
    assert of(region_scores(r, F.col("g"), F.col("p"))) == of(average_iou(region_pairs(g, p), region_counts(g, p)))


def test_flushes_run_on_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(metrics, "BLOCK", 2)
    m = spark.createDataFrame([(i, float(i)) for i in range(30)], "i int, v double")
    got = [(r.batch, r.n, r.total) for r in cumulative_flushes(m, "i", 4, "v").orderBy("batch").collect()]
    assert got == [(b, min(30, 4 * b + 4), float(sum(range(min(30, 4 * b + 4))))) for b in range(8)]


def test_metric_tables(spark):
    m = spark.createDataFrame([(i, i % 3, float(i)) for i in range(10)], "i int, k int, v double")
    assert [(r.bin, r.n) for r in histogram(m, "v", 3).orderBy("bin").collect()] == [(0, 3), (1, 3), (2, 4)]
    assert [(r.k, r.i) for r in last_rows(m, "k", ["i"]).orderBy("k").collect()] == [(0, 9), (1, 7), (2, 8)]
    assert [(r.batch, r.n, r.total) for r in cumulative_flushes(m, "i", 4, "v").orderBy("batch").collect()] == [(0, 4, 6.0), (1, 8, 28.0), (2, 10, 45.0)]
    assert histogram(m.limit(0), "v", 3).count() == 0
