import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.operators import scanlines
from quireflow.operators.raster import polygon_masks, polygon_overlaps, polygon_runs, with_holes
from quireflow.plans.queries import QUERIES

POINTS = "k int, polygon array<struct<x:int,y:int>>, width int, height int"


def _shapes(n=40):
    r = np.random.default_rng(5)
    shapes = [[tuple(map(int, p)) for p in r.integers(-4, 26, size=(int(r.integers(3, 11)), 2))] for _ in range(n)]
    return [*shapes, [], [(3, 3)], [(-9, -9), (-8, -3), (-7, -9)], [(1, 1), (18, 1), (18, 14), (1, 14), (1, 1), (5, 5), (12, 5), (12, 10), (5, 10), (5, 5)]]


def _table(spark, shapes):
    return spark.createDataFrame([(k, s, 20, 16) for k, s in enumerate(shapes)], POINTS)


@pytest.mark.parametrize("query", ["polygon_fill", "mask_holes"])
def test_runs_of_polygons_are_not_shuffled(spark, query):
    plan = QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan, "only regions are dealt out, to be numbered"


@pytest.mark.parametrize("query", ["mask_overlap", "mask_avg_iou"])
def test_words_of_polygons_are_not_shuffled(spark, query):
    plan = QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" not in plan and "collect_list" not in plan


def test_bands_and_chunks_change_nothing(spark, monkeypatch):
    polygons = spark.createDataFrame([(0, _shapes()[0], 20, 16)], POINTS).select("polygon", "width", "height").toArrow()
    columns = _table(spark, _shapes()).select("polygon", "width", "height").toArrow().combine_chunks()
    parts = [columns.column(c).chunk(0) for c in polygons.column_names]
    whole = scanlines.all_drawn(*parts)
    for most in (1, 7, 60, 500):
        monkeypatch.setattr(scanlines, "SIDE_ROWS", most)
        assert all(np.array_equal(a, b) for a, b in zip(whole, scanlines.all_drawn(*parts), strict=True))


def test_coordinates_beyond_longs_products(spark):
    far = 2_147_483_647
    rows = polygon_runs(spark.createDataFrame([(0, [(-far, -far), (far, -far), (far, far), (-far, far)], 30, 7), (1, [(-far, -far), (far, far), (-far, far)], 30, 7)], POINTS), ["k"]).collect()
    assert sorted((r.y, r.x0, r.x1) for r in rows if r.k == 0) == [(y, 0, 30) for y in range(7)]
    assert sorted((r.y, r.x0, r.x1) for r in rows if r.k == 1) == [(y, 0, y + 1) for y in range(7)]


def test_masks_of_polygons_are_those_of_their_runs(spark):
    table = _table(spark, _shapes())
    got = {r.k: r.asDict() for r in polygon_masks(table, ["k"]).collect()}
    assert got == {r.k: r.asDict() for r in with_holes(polygon_runs(table, ["k"]), ["k"]).collect()}
    assert any(r["n_holes"] for r in got.values())


def test_overlaps_of_polygons_are_counted_by_pixel(spark):
    table = _table(spark, _shapes())
    pixels = {}
    for r in polygon_runs(table, ["k"]).collect():
        pixels.setdefault(r.k, set()).update((r.y, x) for x in range(r.x0, r.x1))
    edge = lambda f, c: f(F.transform("polygon", lambda p: p[c]))
    low = lambda c: F.coalesce(edge(F.array_min, c), F.lit(0))
    size = lambda c: F.coalesce(edge(F.array_max, c), F.lit(0)) - low(c)
    side = table.withColumn("box", F.struct(low("x").alias("x"), low("y").alias("y"), size("x").alias("w"), size("y").alias("h"))).withColumn("image_name", F.col("k") % 2)
    got = {(r.gt_idx, r.pred_idx): (r.shared, r.joint) for r in polygon_overlaps(side.withColumnRenamed("k", "gt_idx"), side.withColumnRenamed("k", "pred_idx")).collect()}
    assert got == {(i, j): (len(a & b), len(a | b)) for i, a in pixels.items() for j, b in pixels.items() if i % 2 == j % 2 and a & b}
