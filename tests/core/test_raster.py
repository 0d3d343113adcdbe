import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.functions.geometry import truncated_box
from quireflow.operators.graph import component_labels
from quireflow.operators.images import has_holes, kept_masks, pack_mask
from quireflow.operators.layout import filter_masks
from quireflow.operators.raster import mask_overlaps, packed_words, polygon_runs, polygon_scores, run_words, scaled_runs, with_holes

POINTS = "k int, polygon array<struct<x:int,y:int>>, width int, height int"


def drawn(points, width, height):
    """Pixel by pixel: inside by the even-odd rule at the row's height, or on a side walked in whole steps."""
    mask = np.zeros((height, width), bool)
    sides = list(zip(points, [*points[1:], *points[:1]], strict=True))
    for y in range(height):
        cuts = []
        for (ax, ay), (bx, by) in sides:
            if ay > by:
                ax, ay, bx, by = bx, by, ax, ay
            if ay <= y < by:
                cuts.append((ax * (by - ay) + (y - ay) * (bx - ax), by - ay))
        for x in range(width):
            left = sum(n < x * d for n, d in cuts)
            on = any(n == x * d for n, d in cuts)
            mask[y, x] = left % 2 == 1 or on
    for (ax, ay), (bx, by) in sides:
        steep = abs(by - ay) >= abs(bx - ax)
        (m, o), (mm, oo) = ((ay, ax), (by, bx)) if steep else ((ax, ay), (bx, by))
        if m > mm:
            m, o, mm, oo = mm, oo, m, o
        n = max(mm - m, 1)
        for i in range(mm - m + 1):
            q = o + (2 * i * (oo - o) + n) // (2 * n)
            x, y = (q, m + i) if steep else (m + i, q)
            if 0 <= x < width and 0 <= y < height:
                mask[y, x] = True
    return mask


def of_runs(rows, width, height):
    mask = np.zeros((height, width), bool)
    for r in rows:
        assert 0 <= r.x0 < r.x1 <= width and not mask[r.y, r.x0 : r.x1].any()
        mask[r.y, r.x0 : r.x1] = True
    return mask


def runs_of(masks):
    rows = []
    for k, mask in enumerate(masks):
        edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        rows += [(k, int(y), int(a), int(b)) for (y, a), b in zip(np.argwhere(edges == 1), np.argwhere(edges == -1)[:, 1], strict=True)]
    return rows


def test_polygons_are_filled(spark):
    r = np.random.default_rng(2)
    shapes = [[], [(3, 3)], [(2, 2), (9, 2)], [(1, 1), (5, 9)], [(0, 9), (5, 0), (10, 9), (0, 3), (10, 3)], [(-5, -5), (40, -3), (20, 30)], [(2, 2), (2, 2), (8, 2), (8, 8)]]
    shapes += [[tuple(map(int, p)) for p in r.integers(-6, 26, size=(n, 2))] for n in (3, 4, 5, 6, 7, 9, 12) for _ in range(4)]
    rows = polygon_runs(spark.createDataFrame([(k, s, 20, 16) for k, s in enumerate(shapes)], POINTS), ["k"]).collect()
    for k, s in enumerate(shapes):
        assert np.array_equal(of_runs([r for r in rows if r.k == k], 20, 16), drawn(s, 20, 16)), s


def test_huge_coordinates_cost_only_the_image(spark):
    far = [(-1_000_000_000, -1_000_000_000), (1_000_000_000, -1_000_000_000), (1_000_000_000, 1_000_000_000), (-1_000_000_000, 1_000_000_000)]
    rows = polygon_runs(spark.createDataFrame([(0, far, 30, 7)], POINTS), ["k"]).collect()
    assert sorted((r.y, r.x0, r.x1) for r in rows) == [(y, 0, 30) for y in range(7)]


@pytest.mark.parametrize("to", [(20, 16), (10, 8), (33, 21), (7, 31), (1, 1)])
def test_scaled_masks(spark, to):
    r = np.random.default_rng(to[0])
    mask = r.random((16, 20)) < 0.6
    w, h = to
    rows = spark.createDataFrame([(*x, 20, 16, w, h) for x in runs_of([mask])], "k int, y int, x0 int, x1 int, from_width int, from_height int, width int, height int")
    want = mask[((np.arange(h) + 0.5) * 16 / h).astype(int)][:, ((np.arange(w) + 0.5) * 20 / w).astype(int)]
    assert np.array_equal(of_runs(scaled_runs(rows, ["k"]).collect(), w, h), want)


def test_words_and_overlaps(spark):
    r = np.random.default_rng(7)
    masks = [r.random((11, 37)) < p for p in (0.02, 0.3, 0.5, 0.97, 1.0)] + [np.zeros((11, 37), bool)]
    runs = spark.createDataFrame([(*x, 37) for x in runs_of(masks)], "k int, y int, x0 int, x1 int, width int")
    packed = spark.createDataFrame([(k, bytearray(pack_mask(m))) for k, m in enumerate(masks)], "k int, pixels binary")
    a, b = run_words(runs, ["k"]), packed_words(packed, ["k"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    side = lambda words, name: words.withColumnRenamed("k", name).withColumn("image_name", F.lit("i"))
    got = {(r.gt_idx, r.pred_idx): (r.shared, r.joint) for r in mask_overlaps(side(a, "gt_idx"), side(b, "pred_idx")).collect()}
    assert got == {(i, j): (int((x & y).sum()), int((x | y).sum())) for i, x in enumerate(masks) for j, y in enumerate(masks) if (x & y).any()}


def test_components_of_many_graphs(spark):
    r = np.random.default_rng(1)
    links = [("chain", i, i + 1) for i in range(300)] + [("chain", 7, 7)]
    links += [("loose", int(a), int(b)) for a, b in r.integers(0, 200, size=(120, 2))]
    links += [("star", 1000, i) for i in range(50)]
    nodes = [("chain", i) for i in range(301)] + [("loose", i) for i in range(200)] + [("star", i) for i in [*range(50), 1000]] + [("lone", 5)]
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for k, a, b in links:
        x, y = sorted((find((k, a)), find((k, b))))
        parent[y] = x
    got = component_labels(spark.createDataFrame(nodes, "k string, node int"), spark.createDataFrame(links, "k string, a int, b int"), ["k"]).collect()
    assert sorted((x.k, x.node, x.label) for x in got) == sorted((k, n, find((k, n))[1]) for k, n in nodes)
    assert component_labels(spark.createDataFrame([("a", 1)], "k string, node int"), spark.createDataFrame([], "k string, a int, b int"), ["k"]).first().label == 1


def enclosed(mask):
    """Pixels of background that a flood from outside does not reach, and their parts."""
    ground = np.pad(~mask, 1, constant_values=True)
    number, n = np.zeros(ground.shape, int), 0
    for start in zip(*np.nonzero(ground), strict=True):
        if not number[start]:
            n, todo = n + 1, [start]
            number[start] = n
            while todo:
                y, x = todo.pop()
                for at in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                    if 0 <= at[0] < ground.shape[0] and 0 <= at[1] < ground.shape[1] and ground[at] and not number[at]:
                        number[at] = n
                        todo.append(at)
    return max(n - 1, 0), int((number > 1).sum())


def test_holes_of_random_masks(spark):
    r = np.random.default_rng(3)
    masks = [r.random((h, w)) < p for h, w in ((1, 9), (9, 1), (6, 6), (12, 15), (24, 18)) for p in (0.3, 0.6, 0.75, 0.9) for _ in range(5)]
    spiral = np.ones((15, 15), bool)
    spiral[1, 1:14] = spiral[1:14, 13] = spiral[13, 1:14] = spiral[3:14, 1] = spiral[3, 1:12] = spiral[3:12, 11] = spiral[11, 3:12] = spiral[5:12, 3] = False
    ring = np.ones((9, 9), bool)
    ring[3:6, 3:6] = False
    far = np.zeros((9, 9), bool)
    far[0], far[8] = True, True
    masks += [spiral, ring, far]
    runs = spark.createDataFrame(runs_of(masks), "k int, y int, x0 int, x1 int")
    got = {x.k: x for x in with_holes(runs, ["k"]).collect()}
    for k, mask in enumerate(masks):
        if mask.any():
            ys, xs = np.nonzero(mask)
            n, px = enclosed(mask)
            x = got[k]
            assert (x.n_holes, x.hole_px, x.has_holes) == (n, px, has_holes(mask)), k
            assert (x.x, x.y, x.w, x.h, x.area) == (xs.min(), ys.min(), np.ptp(xs) + 1, np.ptp(ys) + 1, mask.sum())


def test_scores_of_polygons(spark):
    a, b = np.zeros((20, 30), bool), np.zeros((20, 30), bool)
    a[2:8, 3:13] = b[10:18, 15:28] = True
    mask = lambda i, m: (i, bytearray(pack_mask(m)))
    kind = "image_name string, width int, height int, masks array<struct<mask_idx:int,pixels:binary>>"
    found = spark.createDataFrame([("one", 30, 20, [mask(0, a), mask(1, b)]), ("two", 30, 20, [mask(0, a)]), ("none", 30, 20, []), ("only", 30, 20, [mask(0, a)])], kind)
    box = [(3, 2), (12, 2), (12, 7), (3, 7)]
    doubled = [(2 * x, 2 * y) for x, y in ((3, 2), (13, 2), (13, 8), (3, 8))]
    doubled = [(x - (x == 26), y - (y == 16)) for x, y in doubled]
    truth = spark.createDataFrame([("one", 30, 20, [box]), ("two", 60, 40, [doubled, [(0, 0), (1, 0), (1, 1)]]), ("none", 30, 20, []), ("only", 30, 20, [])], "image_name string, true_width int, true_height int, polygons array<array<struct<x:int,y:int>>>")
    got = {r.image_name: (r.n_gt, r.n_pred, r.avg_iou) for r in polygon_scores(found, truth).collect()}
    assert got == {"one": (1, 2, 0.5), "two": (2, 1, 0.5), "none": (0, 0, None), "only": (0, 1, 0.0)}


def test_both_forms_of_the_mask_filter(spark):
    """The filter over a table of masks and the one over an image's array keep the same masks in the same order."""
    r = np.random.default_rng(12)
    rows = []
    for image in range(60):
        for i in range(int(r.integers(1, 6))):
            w, h = (int(v) for v in r.integers(0, 40, 2))
            rows.append((image, i, w, h, int(w * h * r.choice([0.5, 0.91, 1.0])), bool(r.random() < 0.3)))
    flat = spark.createDataFrame(rows, "image_name int, mask_idx int, w int, h int, area long, has_holes boolean")
    one = filter_masks(flat.withColumn("image_px", F.lit(10_000)))
    box = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), "w", "h")
    arrays = flat.groupBy("image_name").agg(F.array_sort(F.collect_list(F.struct("mask_idx", box.alias("box"), "area", "has_holes"))).alias("masks"))
    two = arrays.select("image_name", F.posexplode(kept_masks(F.col("masks"), F.lit(100), F.lit(100))).alias("region_idx", "m"))
    assert sorted((x.image_name, x.region_idx, x.mask_idx) for x in one.collect()) == sorted((x.image_name, x.region_idx, x.m.mask_idx) for x in two.collect())


def test_boxes_are_cut_towards_zero(spark):
    r = spark.createDataFrame([(1.9, -1.9, 3.0, 0.5)], "x double, y double, w double, h double").select(truncated_box(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("b")).first().b
    assert (r.x, r.y, r.w, r.h) == (1, -1, 3, 0)
