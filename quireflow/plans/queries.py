"""Registry of the engine's own queries over the driver's tables, each with the SQL it is compared with."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireflow.functions import geometry as g
from quireflow.functions import text as t
from quireflow.operators import alignment, evaluation, layout, linking, metrics, raster, tagging
from quireflow.sources.images import first_images
from quireflow.sources.metric_sink import MetricSink
from quireflow.sources.page_sink import NAMESPACE, custom_string, page_xml, recognition_json, region_rows
from quireflow.sources.tables import REGIONS_SQL, regions, shared_folder, table
from quireflow.streaming.flush import FLUSH, flush_counted, flush_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- scans, names, images

_IMAGES = "concat('img', p_partkey::VARCHAR, CASE p_size % 5 WHEN 0 THEN '.JPG' WHEN 1 THEN '.png' WHEN 2 THEN '.txt' WHEN 3 THEN '.tiff' ELSE '.xml' END)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.element_at(F.array(*map(F.lit, (".JPG", ".png", ".txt", ".tiff", ".xml"))), F.col("p_size") % 5 + 1)
    return table(spark, sf_dir, "part").select(F.concat(F.lit("img"), F.col("p_partkey").cast("string"), ext).alias("image_name"), "p_partkey")


@query(f"""WITH n AS (SELECT {_IMAGES} AS image_name, p_partkey FROM part),
r AS (SELECT *, (row_number() OVER (ORDER BY image_name) - 1)::INT AS image_index FROM n)
SELECT image_name, p_partkey, image_index FROM r WHERE image_index < 50 AND regexp_matches(lower(image_name), '\\.(jpg|jpeg|png|tiff|tif)$')""")
def image_listing_topn(spark, sf_dir):
    return first_images(_names(spark, sf_dir), 50)


@query(f"""WITH n AS (SELECT {_IMAGES} AS image_name, p_partkey FROM part),
r AS (SELECT *, (row_number() OVER (ORDER BY image_name) - 1)::INT AS image_index FROM n)
SELECT image_name, p_partkey, image_index FROM r WHERE regexp_matches(lower(image_name), '\\.(jpg|jpeg|png|tiff|tif)$')""")
def image_listing_all(spark, sf_dir):
    return first_images(_names(spark, sf_dir), 0)


@query(f"""SELECT image_name, regexp_replace(image_name, '\\.[^.]*$', '') AS stem, regexp_replace(image_name, '\\.[^.]*$', '') || '.xml' AS gt_name FROM (SELECT {_IMAGES} AS image_name FROM part)""")
def image_names(spark, sf_dir):
    return _names(spark, sf_dir).select("image_name", t.stem(F.col("image_name")).alias("stem"), t.ground_truth_name(F.col("image_name")).alias("gt_name"))


@query(f"WITH {REGIONS_SQL} SELECT image_name, region_idx, x / 1920.0::DOUBLE AS nx, y / 1080.0::DOUBLE AS ny, w / 1920.0::DOUBLE AS nw, h / 1080.0::DOUBLE AS nh FROM regions")
def normalized_bbox(spark, sf_dir):
    n = g.normalized_box(F.col("box"), F.lit(1920), F.lit(1080))
    return regions(spark, sf_dir).select("image_name", "region_idx", *[n[c].alias(f"n{c}") for c in "xywh"])


@query(f"WITH {REGIONS_SQL} SELECT image_name, region_idx, concat(x, ',', y, ' ', x + w, ',', y, ' ', x + w, ',', y + h, ' ', x, ',', y + h) AS coords FROM regions")
def bbox_to_coords(spark, sf_dir):
    return regions(spark, sf_dir).select("image_name", "region_idx", g.box_to_coords(*[F.col(f"box.{c}") for c in "xywh"]).alias("coords"))


@query(f"WITH {REGIONS_SQL} SELECT image_name, region_idx, 4 AS n_points, x AS bx, y AS \"by\", w AS bw, h AS bh FROM regions")
def parse_coords(spark, sf_dir):
    points = bbox_to_coords(spark, sf_dir).select("image_name", "region_idx", g.parse_coords(F.col("coords")).alias("p"))
    box = g.bounding_box(F.col("p"))
    return points.select("image_name", "region_idx", F.size("p").alias("n_points"), *[box[c].alias(f"b{c}") for c in "xywh"])


@query("""WITH s AS (SELECT p_partkey, p_size * 97 AS w, (p_partkey % 41 + 1)::INT * 83 AS h FROM part)
SELECT p_partkey, CASE WHEN greatest(w, h) <= 1920 THEN w WHEN w >= h THEN 1920 ELSE floor(1920.0::DOUBLE * w / h)::INT END AS new_w,
CASE WHEN greatest(w, h) <= 1920 THEN h WHEN w >= h THEN floor(1920.0::DOUBLE * h / w)::INT ELSE 1920 END AS new_h FROM s""")
def resize_dims(spark, sf_dir):
    size = g.resized(F.col("p_size") * 97, (F.col("p_partkey") % 41 + 1).cast("int") * 83)
    return table(spark, sf_dir, "part").select("p_partkey", size["w"].alias("new_w"), size["h"].alias("new_h"))


# ---------------------------------------------------------------- layout

_AREA = "(x * 0 + w * h - (image_name % 7 + region_idx * 3) % 11 * w * h // 40)"


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("box.w"), F.col("box.h")
    loss = F.floor((F.col("image_name") % 7 + F.col("region_idx") * 3) % 11 * w * h / 40)
    return regions(spark, sf_dir).select("image_name", F.col("region_idx").alias("mask_idx"), w.alias("w"), h.alias("h"), (w * h - loss).alias("area"), (F.col("l_returnflag") == "R").alias("has_holes"), F.lit(40_000).alias("image_px"))


@query(f"""WITH {REGIONS_SQL},
m AS (SELECT image_name, region_idx AS mask_idx, w, h, {_AREA} AS area, l_returnflag = 'R' AS has_holes FROM regions),
j AS (SELECT *, count(*) OVER (PARTITION BY image_name) AS n, row_number() OVER (PARTITION BY image_name ORDER BY area DESC, mask_idx) AS r,
      coalesce(area / 40000.0::DOUBLE > 0.01 AND area / nullif(w * h, 0) > 0.9 AND NOT has_holes, false) AS ok FROM m),
k AS (SELECT *, bool_or(ok) OVER (PARTITION BY image_name) AS anyok FROM j)
SELECT image_name, mask_idx, area, row_number() OVER (PARTITION BY image_name ORDER BY area DESC, mask_idx) - 1 AS region_idx
FROM k WHERE n = 1 OR ok OR (NOT anyok AND r = 1)""")
def filter_masks(spark, sf_dir):
    return layout.filter_masks(_masks(spark, sf_dir)).select("image_name", "mask_idx", "area", "region_idx")


_PAIRS = """gt AS (SELECT * FROM regions WHERE l_linestatus = 'O'), pr AS (SELECT * FROM regions WHERE l_returnflag <> 'N'),
pairs AS (
  SELECT image_name, gt_idx, pred_idx, i / (aw * ah + bw * bh - i)::DOUBLE AS iou FROM (
    SELECT gt.image_name, gt.region_idx AS gt_idx, pr.region_idx AS pred_idx, gt.w AS aw, gt.h AS ah, pr.w AS bw, pr.h AS bh,
      greatest(0, least(gt.x + gt.w, pr.x + pr.w) - greatest(gt.x, pr.x)) * greatest(0, least(gt.y + gt.h, pr.y + pr.h) - greatest(gt.y, pr.y)) AS i
    FROM gt JOIN pr ON gt.image_name = pr.image_name) WHERE i > 0)"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = regions(spark, sf_dir)
    return r.where("l_linestatus = 'O'"), r.where("l_returnflag <> 'N'")


@query(f"WITH {REGIONS_SQL}, {_PAIRS} SELECT image_name, gt_idx, pred_idx, round(iou, 9) AS iou FROM pairs")
def region_pairs_iou(spark, sf_dir):
    return layout.region_pairs(*_sides(spark, sf_dir)).withColumn("iou", F.round("iou", 9))


@query(f"""WITH {REGIONS_SQL}, {_PAIRS}, best AS (SELECT image_name, gt_idx, max(iou) AS m FROM pairs GROUP BY ALL), s AS (SELECT image_name, sum(m) AS s, count(*) AS c FROM best GROUP BY ALL),
n AS (SELECT image_name, sum(a)::BIGINT AS n_gt, sum(b)::BIGINT AS n_pred FROM (SELECT image_name, 1 AS a, 0 AS b FROM gt UNION ALL SELECT image_name, 0, 1 FROM pr) GROUP BY ALL)
SELECT image_name, n_gt, n_pred, round(coalesce(s, 0) / nullif(coalesce(c, 0) + abs(n_gt - n_pred), 0), 9) AS avg_iou FROM n LEFT JOIN s USING (image_name)""")
def layout_avg_iou(spark, sf_dir):
    return layout.region_scores(regions(spark, sf_dir), F.col("l_linestatus") == "O", F.col("l_returnflag") != "N").withColumn("avg_iou", F.round("avg_iou", 9))


# ---------------------------------------------------------------- masks as rows

#: Region outlines: a star that crosses itself, or a frame around an opening, in the region's box; the page is 128 by 84 pixels.
_STAR = (["x", "x + w // 2", "x + w", "x", "x + w"], ["y + h", "y", "y + h", "y + h // 3", "y + h // 3"])
_FRAME = (["x", "x + w", "x + w", "x", "x", "x + w // 4", "x + w - w // 4", "x + w - w // 4", "x + w // 4", "x + w // 4"], ["y", "y", "y + h", "y + h", "y", "y + h // 4", "y + h // 4", "y + h - h // 4", "y + h - h // 4", "y + h // 4"])
_PAGE = (128, 84)
_DOWN = lambda a, b: f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"
_FILLED = f"""polys AS (SELECT image_name, region_idx, CASE WHEN region_idx % 2 = 0 THEN [{", ".join(_STAR[0])}] ELSE [{", ".join(_FRAME[0])}] END AS xs, CASE WHEN region_idx % 2 = 0 THEN [{", ".join(_STAR[1])}] ELSE [{", ".join(_FRAME[1])}] END AS ys FROM regions),
sides AS (SELECT image_name, region_idx, xs[i]::BIGINT AS ax, ys[i]::BIGINT AS ay, xs[i % len(xs) + 1]::BIGINT AS bx, ys[i % len(xs) + 1]::BIGINT AS by_ FROM (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM polys)),
up AS (SELECT image_name, region_idx, CASE WHEN ay <= by_ THEN ax ELSE bx END AS tx, least(ay, by_) AS ty, CASE WHEN ay <= by_ THEN bx ELSE ax END AS ux, greatest(ay, by_) AS uy FROM sides),
cut AS (SELECT image_name, region_idx, y, tx + ((y - ty) * (ux - tx))::DOUBLE / (uy - ty) AS place, tx - ({_DOWN("-((y - ty) * (ux - tx))", "uy - ty")}) AS l, tx + ({_DOWN("(y - ty) * (ux - tx)", "uy - ty")}) AS r FROM (SELECT *, unnest(range(ty, uy)) AS y FROM up WHERE ty < uy)),
pair AS (SELECT *, lead(r) OVER v AS e, row_number() OVER v AS n FROM cut WINDOW v AS (PARTITION BY image_name, region_idx, y ORDER BY place)),
walk AS (SELECT image_name, region_idx, steep, CASE WHEN m0 <= m1 THEN m0 ELSE m1 END AS ma, CASE WHEN m0 <= m1 THEN o0 ELSE o1 END AS oa, greatest(m0, m1) AS mb, CASE WHEN m0 <= m1 THEN o1 ELSE o0 END AS ob
  FROM (SELECT *, CASE WHEN steep THEN ay ELSE ax END AS m0, CASE WHEN steep THEN ax ELSE ay END AS o0, CASE WHEN steep THEN by_ ELSE bx END AS m1, CASE WHEN steep THEN bx ELSE by_ END AS o1 FROM (SELECT *, abs(by_ - ay) >= abs(bx - ax) AS steep FROM sides))),
step AS (SELECT image_name, region_idx, steep, m, oa + ({_DOWN("2 * (m - ma) * (ob - oa) + greatest(mb - ma, 1)", "2 * greatest(mb - ma, 1)")}) AS o FROM (SELECT *, unnest(range(ma, mb + 1)) AS m FROM walk)),
run AS (SELECT image_name, region_idx, y, l AS x0, e + 1 AS x1 FROM pair WHERE n % 2 = 1 AND e IS NOT NULL AND l <= e UNION ALL SELECT image_name, region_idx, CASE WHEN steep THEN m ELSE o END, CASE WHEN steep THEN o ELSE m END, CASE WHEN steep THEN o ELSE m END + 1 FROM step),
mark AS (SELECT *, CASE WHEN x0 <= max(x1) OVER (PARTITION BY image_name, region_idx, y ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM run),
isle AS (SELECT *, sum(new) OVER (PARTITION BY image_name, region_idx, y ORDER BY x0, x1) AS island FROM mark),
filled AS (SELECT image_name, region_idx, y, min(x0) AS x0, max(x1) AS x1 FROM isle GROUP BY image_name, region_idx, y, island)"""


def _outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_name, region_idx, polygon, width, height) of all regions."""

    def points(of: tuple[list[str], list[str]]):
        column = lambda e: F.expr(re.sub(r"(\w) // (\d)", r"(\1 div \2)", e)).cast("int")
        return F.array(*[F.struct(column(x).alias("x"), column(y).alias("y")) for x, y in zip(*of, strict=True)])

    boxed = regions(spark, sf_dir).select("image_name", "region_idx", "box", "box.*", "l_linestatus", "l_returnflag")
    shape = F.when(F.col("region_idx") % 2 == 0, points(_STAR)).otherwise(points(_FRAME))
    return boxed.select("image_name", "region_idx", "box", shape.alias("polygon"), F.lit(_PAGE[0]).alias("width"), F.lit(_PAGE[1]).alias("height"), "l_linestatus", "l_returnflag")


_KEY = ["image_name", "region_idx"]


@query(f"WITH {REGIONS_SQL}, {_FILLED} SELECT image_name, region_idx, count(*) AS n_runs, sum(x1 - x0)::BIGINT AS area, sum((y * 131 + x0) * 17 + x1)::BIGINT AS checked FROM filled GROUP BY image_name, region_idx")
def polygon_fill(spark, sf_dir):
    total = lambda each: F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + each(r))
    drawn = raster.drawn_polygons(_outlines(spark, sf_dir), _KEY)
    return drawn.select(*_KEY, F.size("runs").cast("long").alias("n_runs"), total(lambda r: r["x1"] - r["x0"]).alias("area"), total(lambda r: (r["y"] * 131 + r["x0"]) * 17 + r["x1"]).alias("checked"))


_SHARED = """px AS (SELECT image_name, region_idx, sum(x1 - x0) AS area FROM filled GROUP BY ALL), flagged AS (SELECT image_name, region_idx, l_linestatus = 'O' AS g, l_returnflag <> 'N' AS p FROM regions),
met AS (SELECT a.image_name, a.region_idx AS gt_idx, b.region_idx AS pred_idx, sum(greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)))::BIGINT AS shared
  FROM filled a JOIN flagged ga ON ga.image_name = a.image_name AND ga.region_idx = a.region_idx AND ga.g JOIN filled b ON a.image_name = b.image_name AND a.y = b.y JOIN flagged gb ON gb.image_name = b.image_name AND gb.region_idx = b.region_idx AND gb.p GROUP BY ALL),
pairs AS (SELECT m.image_name, gt_idx, pred_idx, shared, (a.area + b.area - shared)::BIGINT AS joint FROM met m JOIN px a ON a.image_name = m.image_name AND a.region_idx = gt_idx JOIN px b ON b.image_name = m.image_name AND b.region_idx = pred_idx WHERE shared > 0)"""


def _mask_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    outlines = _outlines(spark, sf_dir)
    side = lambda condition, name: outlines.where(condition).withColumnRenamed("region_idx", name)
    return raster.polygon_overlaps(side("l_linestatus = 'O'", "gt_idx"), side("l_returnflag <> 'N'", "pred_idx"))


@query(f"WITH {REGIONS_SQL}, {_FILLED}, {_SHARED} SELECT image_name, gt_idx, pred_idx, shared, joint, round(shared / joint, 9) AS iou FROM pairs")
def mask_overlap(spark, sf_dir):
    return _mask_pairs(spark, sf_dir).withColumn("iou", F.round("iou", 9))


@query(f"""WITH {REGIONS_SQL}, {_FILLED}, {_SHARED}, best AS (SELECT image_name, gt_idx, max(shared / joint) AS m FROM pairs GROUP BY ALL), s AS (SELECT image_name, sum(m) AS s, count(*) AS c FROM best GROUP BY ALL),
n AS (SELECT image_name, sum(g::INT)::BIGINT AS n_gt, sum(p::INT)::BIGINT AS n_pred FROM flagged WHERE g OR p GROUP BY ALL)
SELECT image_name, n_gt, n_pred, round(coalesce(s, 0) / nullif(coalesce(c, 0) + abs(n_gt - n_pred), 0), 9) AS avg_iou FROM n LEFT JOIN s USING (image_name)""")
def mask_avg_iou(spark, sf_dir):
    counts = layout.region_counts(*_sides(spark, sf_dir))
    return layout.average_iou(_mask_pairs(spark, sf_dir), counts).withColumn("avg_iou", F.round("avg_iou", 9))


@query(f"""WITH RECURSIVE {REGIONS_SQL}, {_FILLED},
size AS (SELECT image_name, region_idx, min(x0) AS x, min(y) AS y, max(x1) - min(x0) AS w, max(y) - min(y) + 1 AS h, sum(x1 - x0)::BIGINT AS area FROM filled GROUP BY image_name, region_idx),
between_ AS (SELECT * FROM (SELECT image_name, region_idx, y, lag(x1) OVER (PARTITION BY image_name, region_idx, y ORDER BY x0) AS a, x0 AS b FROM filled) WHERE a IS NOT NULL),
ends AS (SELECT image_name, region_idx, y, min(x0) AS first, max(x1) AS last FROM filled GROUP BY ALL),
free AS (SELECT g.image_name, g.region_idx, g.y, g.a, g.b FROM between_ g LEFT JOIN ends u ON u.image_name = g.image_name AND u.region_idx = g.region_idx AND u.y = g.y - 1 LEFT JOIN ends d ON d.image_name = g.image_name AND d.region_idx = g.region_idx AND d.y = g.y + 1
  WHERE u.y IS NULL OR d.y IS NULL OR g.a < u.first OR g.b > u.last OR g.a < d.first OR g.b > d.last),
reached(image_name, region_idx, y, a, b) AS (SELECT * FROM free UNION SELECT g.image_name, g.region_idx, g.y, g.a, g.b FROM reached r JOIN between_ g ON g.image_name = r.image_name AND g.region_idx = r.region_idx AND abs(g.y - r.y) = 1 AND g.a < r.b AND r.a < g.b),
shut AS (SELECT image_name, region_idx, sum(b - a)::BIGINT AS hole_px FROM (SELECT * FROM between_ EXCEPT SELECT * FROM reached) GROUP BY ALL)
SELECT image_name, region_idx, x, y, w, h, area, coalesce(hole_px, 0)::BIGINT AS hole_px, hole_px IS NOT NULL AS has_holes FROM size LEFT JOIN shut USING (image_name, region_idx)""")
def mask_holes(spark, sf_dir):
    return raster.polygon_masks(_outlines(spark, sf_dir), _KEY).drop("n_holes")


# ---------------------------------------------------------------- readings

_READ = "SELECT a.p_partkey AS k, a.p_name || ' ' || a.p_type AS truth, b.p_name || ' ' || b.p_type AS read FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1"


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("truth"))
    nxt = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("truth").alias("read"))
    return p.join(nxt, "p_partkey").withColumnRenamed("p_partkey", "k")


@query(f"SELECT k, round(levenshtein(read, truth) / length(truth), 9) AS cer FROM ({_READ})")
def cer_per_region(spark, sf_dir):
    return evaluation.region_errors(_readings(spark, sf_dir)).select("k", F.round("cer", 9).alias("cer"))


@query(f"SELECT round(sum(levenshtein(read, truth)) / sum(length(truth)), 9) AS cer FROM ({_READ})")
def cer_corpus(spark, sf_dir):
    r = _readings(spark, sf_dir)
    return r.agg(F.round(F.sum(F.levenshtein("read", "truth")) / F.sum(F.length("truth")), 9).alias("cer"))


@query("SELECT a.l_orderkey FROM (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL) a JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL) b ON a.l_orderkey = b.l_orderkey AND a.n = b.n")
def cer_count_gate(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return evaluation.count_gate(lines.where("l_linestatus = 'O'"), lines.where("l_returnflag <> 'N'"), "l_orderkey")


@query("""WITH s AS (SELECT p_partkey // 2 AS k, (p_partkey % 2)::INT AS i, p_name AS g, p_type || ' ' || reverse(p_name) AS p FROM part),
f AS (SELECT k FROM s GROUP BY k HAVING count(*) = 2),
t AS (SELECT a.k, a.g AS g0, b.g AS g1, a.p AS p0, b.p AS p1 FROM s a JOIN s b ON a.k = b.k AND a.i = 0 AND b.i = 1 JOIN f ON f.k = a.k),
c AS (SELECT *, levenshtein(p0, g0) + levenshtein(p1, g1) <= levenshtein(p1, g0) + levenshtein(p0, g1) AS same FROM t)
SELECT k, 0 AS bb_index, round(CASE WHEN same THEN levenshtein(p0, g0) ELSE levenshtein(p1, g0) END / length(g0), 9) AS cer FROM c
UNION ALL SELECT k, 1, round(CASE WHEN same THEN levenshtein(p1, g1) ELSE levenshtein(p0, g1) END / length(g1), 9) FROM c""")
def cer_assignment(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 2).alias("k"), (F.col("p_partkey") % 2).cast("int").alias("idx"), "p_name", "p_type")
    full = part.groupBy("k").count().where("count = 2").select("k")
    part = part.join(full, "k")
    gt = part.select("k", "idx", F.lit("gt").alias("side"), F.col("p_name").alias("text"))
    pred = part.select("k", "idx", F.lit("pred").alias("side"), F.concat_ws(" ", "p_type", F.reverse("p_name")).alias("text"))
    return evaluation.assigned_errors(gt.unionByName(pred), "k").withColumn("cer", F.round("cer", 9))


_THREE = [(0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0)]
_SUMS = [" + ".join(f"d{r}{c}" for c, r in enumerate(o)) for o in _THREE]


@query(f"""WITH s AS (SELECT p_partkey // 3 AS k, (p_partkey % 3)::INT AS i, p_name AS g, reverse(p_name) || p_type AS p FROM part),
t AS (SELECT a.k, a.g AS g0, b.g AS g1, c.g AS g2, a.p AS p0, b.p AS p1, c.p AS p2 FROM s a JOIN s b ON a.k = b.k AND b.i = 1 JOIN s c ON a.k = c.k AND c.i = 2 WHERE a.i = 0),
d AS (SELECT *, {", ".join(f"levenshtein(p{r}, g{c}) AS d{r}{c}" for r in range(3) for c in range(3))} FROM t), m AS (SELECT *, least({", ".join(_SUMS)}) AS m FROM d),
o AS (SELECT *, CASE {" ".join(f"WHEN {x} = m THEN [{', '.join(f'd{r}{c}' for c, r in enumerate(o))}]" for x, o in zip(_SUMS, _THREE, strict=True))} END AS e FROM m)
SELECT k, i::INT AS bb_index, round(e[i + 1] / length([g0, g1, g2][i + 1]), 9) AS cer FROM o, range(3) r(i)""")
def cer_assignment_three(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 3).alias("k"), (F.col("p_partkey") % 3).cast("int").alias("idx"), "p_name", "p_type")
    part = part.join(part.groupBy("k").count().where("count = 3").select("k"), "k")
    gt = part.select("k", "idx", F.lit("gt").alias("side"), F.col("p_name").alias("text"))
    pred = part.select("k", "idx", F.lit("pred").alias("side"), F.concat(F.reverse("p_name"), "p_type").alias("text"))
    return evaluation.assigned_errors(gt.unionByName(pred), "k").withColumn("cer", F.round("cer", 9))


_FIVE = list(itertools.permutations(range(5)))
_FIVE_SUMS = [" + ".join(f"d{r}{c}" for c, r in enumerate(o)) for o in _FIVE]


@query(f"""WITH s AS (SELECT p_partkey // 5 AS k, (p_partkey % 5)::INT AS i, p_name || p_size AS g, reverse(p_name) || p_type AS p FROM part),
t AS (SELECT k, {", ".join(f"max(CASE WHEN i = {i} THEN {x} END) AS {x}{i}" for i in range(5) for x in "gp")} FROM s GROUP BY k HAVING count(*) = 5),
d AS (SELECT *, {", ".join(f"levenshtein(p{r}, g{c}) AS d{r}{c}" for r in range(5) for c in range(5))} FROM t), m AS (SELECT *, least({", ".join(_FIVE_SUMS)}) AS m FROM d),
o AS (SELECT *, CASE {" ".join(f"WHEN {x} = m THEN [{', '.join(f'd{r}{c}' for c, r in enumerate(o))}]" for x, o in zip(_FIVE_SUMS, _FIVE, strict=True))} END AS e FROM m)
SELECT k, i::INT AS bb_index, round(e[i + 1] / length([g0, g1, g2, g3, g4][i + 1]), 9) AS cer FROM o, range(5) r(i)""")
def cer_assignment_five(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 5).alias("k"), (F.col("p_partkey") % 5).cast("int").alias("idx"), "p_name", "p_type", "p_size")
    part = part.join(part.groupBy("k").count().where("count = 5").select("k"), "k")
    gt = part.select("k", "idx", F.lit("gt").alias("side"), F.concat("p_name", F.col("p_size").cast("string")).alias("text"))
    pred = part.select("k", "idx", F.lit("pred").alias("side"), F.concat(F.reverse("p_name"), "p_type").alias("text"))
    return evaluation.assigned_errors(gt.unionByName(pred), "k").withColumn("cer", F.round("cer", 9))


@query("""WITH r AS (SELECT p_partkey AS k, p_name || ' ' || p_type || p_size AS a, replace(p_name, 'o', '0') || p_type || CASE WHEN p_partkey % 4 = 0 THEN ' ' || reverse(p_name) ELSE '' END AS b FROM part)
SELECT k, levenshtein(a, b)::INT AS edits, length(a)::INT AS chars_a, length(b)::INT AS chars_b, TRUE AS leads_from_a, TRUE AS leads_to_b FROM r""")
def reading_alignment(spark, sf_dir):
    """Two runs' readings aligned: the script is as short as the distance, and spells both texts."""
    n = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    one = part.select(n.alias("k"), F.concat("p_name", F.lit(" "), "p_type", F.col("p_size").cast("string")).alias("text"))
    two = part.select(n.alias("k"), F.concat(F.replace("p_name", F.lit("o"), F.lit("0")), "p_type", F.when(n % 4 == 0, F.concat(F.lit(" "), F.reverse("p_name"))).otherwise("")).alias("text"))
    both = alignment.aligned_readings(one, two, ["k"])
    spelt = lambda side: F.array_join(F.transform("script", lambda r: r[side]), "")
    told = both.select("k", "script", *[(spelt(x) == F.col(f"text_{x}")).alias(n) for x, n in (("a", "leads_from_a"), ("b", "leads_to_b"))])
    sizes = alignment.script_sizes(told, ["k", "leads_from_a", "leads_to_b"])
    return sizes.select("k", "edits", (F.col("kept") + F.col("changed") + F.col("dropped")).alias("chars_a"), (F.col("kept") + F.col("changed") + F.col("added")).alias("chars_b"), "leads_from_a", "leads_to_b")


@query(r"""SELECT doc_id, replace(t, chr(13) || chr(10), chr(10)) AS unix, regexp_replace(replace(u, chr(10) || chr(10), chr(10)), '^\s+|\s+$', '', 'g') AS cleaned
FROM (SELECT doc_id, replace(text, chr(10), chr(13) || chr(10)) AS t, chr(10) || replace(text, '. ', '.' || chr(10) || chr(10)) || '  ' AS u FROM documents)""")
def newline_normalise(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    windows = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    answer = F.concat(F.lit("\n"), F.replace("text", F.lit(". "), F.lit(".\n\n")), F.lit("  "))
    return d.select("doc_id", t.unix_newlines(windows).alias("unix"), t.cleaned_reading(answer).alias("cleaned"))


# ---------------------------------------------------------------- ground truth

_CUSTOM = "'readingOrder {index:' || l_linenumber || ';} Geo_Town {offset:' || l_partkey || '; length:' || l_suppkey || '; Geonames:' || l_orderkey || ';}'"


@query("SELECT l_orderkey, l_linenumber, 2 AS n_attrs, l_partkey AS \"offset\", l_suppkey AS \"length\", l_orderkey AS geoname_id FROM lineitem")
def custom_attr_parse(spark, sf_dir):
    custom = F.expr(_CUSTOM)
    attrs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", t.custom_attributes(custom).alias("a"))
    body = F.filter("a", lambda x: x["tag"] == "Geo_Town")[0]["body"]
    return attrs.select("l_orderkey", "l_linenumber", F.size("a").alias("n_attrs"), *[t.attribute_value(body, k).cast("bigint").alias(n) for k, n in (("offset", "offset"), ("length", "length"), ("Geonames", "geoname_id"))])


@query("""WITH l AS (SELECT l_orderkey AS image_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i, l_partkey % 3 AS o, l_suppkey % 8 + 1 AS n, l_orderkey AS id FROM lineitem)
SELECT image_name, (11 * i)::INT AS start, (11 * i + CASE WHEN o + n > 5 THEN 9 ELSE 4 END)::INT AS "end", CASE WHEN o + n > 5 THEN 'abcd efgh' ELSE 'abcd' END AS tagged, id AS geoname_id FROM l""")
def gt_prepared(spark, sf_dir):
    r = regions(spark, sf_dir, "l_partkey", "l_suppkey")
    custom = F.concat(F.lit("readingOrder {index:0;} Geo_Town {offset:"), F.col("l_partkey") % 3, F.lit("; length:"), F.col("l_suppkey") % 8 + 1, F.lit("; Geonames:"), F.col("image_name"), F.lit(";}"))
    lines = r.select("image_name", F.lit(0).alias("region_idx"), F.col("region_idx").alias("line_idx"), F.lit("abcd efgh").alias("text"), t.custom_attributes(custom).alias("attrs"))
    spans = evaluation.prepared_truth(lines, ("Geo_Town",))[1]
    return spans.select("image_name", "start", "end", F.col("text").alias("tagged"), "geoname_id")


@query("SELECT conv_id, turn, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM conversations")
def gt_line_offsets(spark, sf_dir):
    return evaluation.line_offsets(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text").select("conv_id", "turn", F.col("start").cast("long").alias("start"))


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def gt_text_join(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(t.ordered_join(F.col("turn"), F.col("text"), "\n\n").alias("text"))


@query("SELECT d.doc_id, l.quality, l.doc_id IS NOT NULL AS has_truth FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def gt_left_join(spark, sf_dir):
    truth = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("has_truth"))
    return table(spark, sf_dir, "documents").select("doc_id").join(truth, "doc_id", "left").select("doc_id", "quality", F.coalesce("has_truth", F.lit(False)).alias("has_truth"))


# ---------------------------------------------------------------- tags

#: A label's text: name, date, type, address, sex sign and coordinates, by the part's key.
_DATE = """(CASE p_partkey % 3 WHEN 0 THEN (p_partkey % 28 + 1) || '.' || (p_partkey % 12 + 1) || '.' WHEN 1 THEN (p_partkey % 28 + 1) || '.IV.' ELSE 'VI.' END || '19' || lpad((p_partkey % 100)::VARCHAR, 2, '0'))"""
_LABEL = f"""p_name || ', ' || {_DATE} || ' '
 || CASE p_size % 4 WHEN 0 THEN 'Holotype' WHEN 1 THEN 'paratypus' WHEN 2 THEN 'atype' ELSE 'x' END
 || CASE WHEN p_partkey % 3 = 0 THEN ' http://coll.example.org/u/ab' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') ELSE '' END
 || CASE WHEN p_partkey % 5 = 0 THEN ' ' || chr(9794) ELSE '' END
 || ' ' || (p_partkey % 90) || chr(176) || (p_partkey % 60) || '''' || CASE p_partkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'E' WHEN 2 THEN 'S' ELSE 'W' END"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_partkey")
    pick = lambda c, *v: F.element_at(F.array(*map(F.lit, v)), (c + 1).cast("int"))
    text = F.concat(
        "p_name", F.lit(", "), F.when(n % 3 == 0, F.concat(n % 28 + 1, F.lit("."), n % 12 + 1, F.lit("."))).when(n % 3 == 1, F.concat(n % 28 + 1, F.lit(".IV."))).otherwise(F.lit("VI.")),
        F.lit("19"), F.lpad((n % 100).cast("string"), 2, "0"), F.lit(" "), pick(F.col("p_size") % 4, "Holotype", "paratypus", "atype", "x"),
        F.when(n % 3 == 0, F.concat(F.lit(" http://coll.example.org/u/ab"), F.lpad((n % 10000).cast("string"), 4, "0"))).otherwise(F.lit("")),
        F.when(n % 5 == 0, F.lit(" ♂")).otherwise(F.lit("")), F.lit(" "), n % 90, F.lit("°"), n % 60, F.lit("'"), pick(n % 4, "N", "E", "S", "W"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))


def _tag_query(name: str, label: str, found: str):
    """found: SQL for the tagged text, null without a tag; each text has one at most."""

    def f(spark, sf_dir):
        tagged = tagging.with_tags(_labels(spark, sf_dir), labels=(label,))
        s = tagged.select("p_partkey", F.explode("tags").alias("s"))
        return s.select("p_partkey", "s.label", "s.start", "s.end", F.col("s.text").alias("tagged"))

    f.__name__ = name
    query(f"""WITH l AS (SELECT p_partkey, p_size, {_LABEL} AS text FROM part), s AS (SELECT p_partkey, text, {found} AS tagged FROM l)
SELECT p_partkey, '{label}' AS label, instr(text, tagged) - 1 AS start, (instr(text, tagged) - 1 + length(tagged)) AS "end", tagged FROM s WHERE tagged <> ''""")(f)


_DEG = "(p_partkey % 90) || chr(176) || (p_partkey % 60) || ''''"
_tag_query("tag_dates", "GatheringDate", _DATE)
_tag_query("tag_types", "Type", r"regexp_extract(text, '\b(?i:holotype|paratypus)\b')")
_tag_query("tag_nuri", "NURI", r"regexp_extract(text, 'http://coll\.example\.org/u/[a-z0-9]{6}')")
_tag_query("tag_sex", "Sex", "regexp_extract(text, chr(9794))")
_tag_query("tag_lat", "Geo_Latitude", f"CASE p_partkey % 4 WHEN 0 THEN {_DEG} || 'N' WHEN 2 THEN {_DEG} || 'S' END")
_tag_query("tag_lon", "Geo_Longitude", f"CASE p_partkey % 4 WHEN 1 THEN {_DEG} || 'E' WHEN 3 THEN {_DEG} || 'W' END")

_SPANS = """SELECT image_name, region_idx, x AS start, x + w AS "end", l_returnflag AS label FROM regions"""


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = regions(spark, sf_dir)
    return r.select("image_name", "region_idx", F.col("box.x").alias("start"), (F.col("box.x") + F.col("box.w")).alias("end"), F.col("l_returnflag").alias("label"))


_SCORES = """coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r"""
_F1 = "round_even(p * 100, 2) AS precision, round_even(r * 100, 2) AS recall, round_even(coalesce(2 * p * r / nullif(p + r, 0), 0) * 100, 2) AS f1"


@query(f"""WITH {REGIONS_SQL}, s AS ({_SPANS}), g AS (SELECT DISTINCT image_name, start, "end", label FROM s), p AS (SELECT DISTINCT image_name, start + CASE WHEN region_idx % 3 = 1 THEN 1 ELSE 0 END AS start, "end", label FROM s),
b AS (SELECT coalesce(g.image_name, p.image_name) % 10 AS grp, g.label IS NOT NULL AS ing, p.label IS NOT NULL AS inp FROM g FULL JOIN p ON g.image_name = p.image_name AND g.start = p.start AND g."end" = p."end" AND g.label = p.label),
c AS (SELECT grp, count_if(ing AND inp)::BIGINT AS tp, count_if(NOT ing)::BIGINT AS fp, count_if(NOT inp)::BIGINT AS fn FROM b GROUP BY grp), q AS (SELECT *, {_SCORES} FROM c)
SELECT grp, tp, fp, fn, {_F1} FROM q""")
def tag_prf(spark, sf_dir):
    s = _spans(spark, sf_dir).withColumn("grp", F.col("image_name") % 10)
    moved = s.withColumn("start", F.col("start") + F.when(F.col("region_idx") % 3 == 1, 1).otherwise(0))
    return evaluation.tag_scores(s, moved, ["grp", "image_name", "start", "end", "label"], ["grp"])


@query(f"""WITH {REGIONS_SQL}, s AS ({_SPANS}), g AS (SELECT image_name, start, "end", label FROM s WHERE region_idx = 0),
p AS (SELECT image_name, region_idx, start - CASE WHEN region_idx % 2 = 1 THEN x ELSE 0 END AS start, "end" - CASE WHEN region_idx % 2 = 1 THEN x ELSE 0 END AS "end", label FROM (SELECT s.*, s.start - g.start AS x FROM s JOIN g USING (image_name))),
c AS (SELECT p.image_name, p.region_idx, count_if(p.start = g.start AND p."end" = g."end" AND p.label = g.label)::BIGINT AS tp FROM p JOIN g ON p.image_name = g.image_name GROUP BY ALL),
n AS (SELECT image_name, region_idx, tp, 1 - tp AS fp, 1 - tp AS fn FROM c), q AS (SELECT *, {_SCORES} FROM n) SELECT image_name, region_idx, tp, fp, fn, {_F1} FROM q""")
def tag_first_region(spark, sf_dir):
    s = _spans(spark, sf_dir)
    first = s.where("region_idx = 0").select("image_name", F.col("start").alias("g_start"))
    by = F.when(F.col("region_idx") % 2 == 1, F.col("start") - F.col("g_start")).otherwise(0)
    found = s.join(first, "image_name").withColumn("by", by).withColumns({"start": F.col("start") - F.col("by"), "end": F.col("end") - F.col("by")})
    return evaluation.region_tag_scores(s, found)


@query(f"""WITH {REGIONS_SQL}, s AS (SELECT image_name, region_idx, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS tag FROM regions),
l AS (SELECT *, region_idx = 0 AS first, 'abcd' AS text FROM s), g AS (SELECT image_name, tag FROM l WHERE first),
c AS (SELECT l.image_name, l.region_idx, (g.tag IS NOT NULL AND l.region_idx % 2 = 0 AND g.tag = 'A')::INT::BIGINT AS tp, (g.tag IS NOT NULL)::INT::BIGINT AS n_true, (l.region_idx % 2 = 0)::INT::BIGINT AS n_found FROM l JOIN g USING (image_name)),
n AS (SELECT image_name, region_idx, tp, n_found - tp AS fp, n_true - tp AS fn FROM c), q AS (SELECT *, {_SCORES} FROM n) SELECT image_name, region_idx, tp, fp, fn, {_F1} FROM q""")
def tag_untagged_first(spark, sf_dir):
    """Prepared page truth whose first regions are partly without a tag: what is found is held against those all the same."""
    r = regions(spark, sf_dir)
    tag = F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", F.lit(" {offset:0; length:4;}"))).otherwise("")
    lines = r.select("image_name", "region_idx", F.lit(0).alias("line_idx"), F.lit("abcd").alias("text"), t.custom_attributes(F.concat(F.lit("readingOrder {index:0;} "), tag)).alias("attrs"))
    texts, spans = evaluation.prepared_truth(lines, ("A", "N"))
    tagged = F.col("region_idx") % 2 == 0
    found = r.select("image_name", "region_idx", F.when(tagged, 0).alias("start"), F.when(tagged, 4).alias("end"), F.when(tagged, "A").alias("label"))
    return evaluation.region_tag_scores(spans, found, texts)


# ---------------------------------------------------------------- links

_NAMED = "SELECT c_custkey AS image_name, CASE WHEN c_custkey % 3 = 0 THEN 'Geo_Town' WHEN c_custkey % 3 = 1 THEN 'Geo_Country' ELSE 'Sex' END AS label, 'NATION_' || (c_nationkey + c_custkey % 4) AS text, c_nationkey FROM customer"


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    label = F.when(k % 3 == 0, "Geo_Town").when(k % 3 == 1, "Geo_Country").otherwise("Sex")
    return table(spark, sf_dir, "customer").select(k.alias("image_name"), label.alias("label"), F.concat(F.lit("NATION_"), (F.col("c_nationkey") + k % 4).cast("string")).alias("text"), "c_nationkey")


def _gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    ids = F.array(F.struct(F.lit(0).alias("rank"), F.col("n_nationkey").cast("bigint").alias("geoname_id")), F.struct(F.lit(1).alias("rank"), (F.col("n_nationkey") + 1000).cast("bigint").alias("geoname_id")))
    return n.select(F.col("n_name").alias("name"), F.explode(ids).alias("i")).select("name", "i.*")


@query(f"SELECT image_name, label, text, n_nationkey || ',' || (n_nationkey + 1000) AS geoname_ids FROM ({_NAMED}) s JOIN nation ON text = n_name WHERE label <> 'Sex'")
def link_gazetteer(spark, sf_dir):
    linked = linking.link_spans(_places(spark, sf_dir), _gazetteer(spark, sf_dir))
    return linked.select("image_name", "label", "text", F.array_join("geoname_ids", ",").alias("geoname_ids"))


@query(f"""WITH s AS ({_NAMED}), q AS (SELECT DISTINCT text FROM s WHERE label <> 'Sex'), n AS (SELECT q.text, n_nationkey AS id, levenshtein(q.text, n_name) AS d FROM q JOIN nation ON levenshtein(q.text, n_name) <= 1),
i AS (SELECT text, string_agg(id::VARCHAR, ';' ORDER BY d, id) AS ids FROM n GROUP BY text) SELECT image_name, text, ids FROM s JOIN i USING (text) WHERE label <> 'Sex'""")
def link_fuzzy(spark, sf_dir):
    gaz = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit(0).alias("rank"), F.col("n_nationkey").cast("bigint").alias("geoname_id"))
    return linking.link_spans(_places(spark, sf_dir), gaz, distance=1).select("image_name", "text", F.array_join("geoname_ids", ";").alias("ids"))


_SPELT = "WITH p AS (SELECT p_partkey AS image_name, p_name || ' ' || p_type AS name FROM part), s AS (SELECT image_name, name, left(name, (image_name % 7 + 1)::INT) || substr(name, (image_name % 7 + 3)::INT) || CASE WHEN image_name % 3 = 0 THEN 'x' ELSE '' END AS text FROM p)"


@query(f"""{_SPELT}, k AS (SELECT name, min(image_name) AS id FROM p GROUP BY name), q AS (SELECT DISTINCT text FROM s),
n AS (SELECT text, id, levenshtein(text, name) AS d FROM q JOIN k ON levenshtein(text, name) <= floor(greatest(length(text), length(name)) * 0.2 + 1e-9)),
i AS (SELECT text, string_agg(id::VARCHAR, ';' ORDER BY d, id) AS ids FROM n GROUP BY text) SELECT image_name, text, ids FROM s JOIN i USING (text)""")
def link_similar(spark, sf_dir):
    """Misspelt names and all known names that are at least 0.8 alike, nearest first."""
    k = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").select(k.alias("image_name"), F.concat("p_name", F.lit(" "), "p_type").alias("name"))
    n = (F.col("image_name") % 7).cast("int")
    spelt = F.concat(F.left("name", n + 1), F.substring(F.col("name"), n + 3, F.length("name")), F.when(F.col("image_name") % 3 == 0, "x").otherwise(""))
    spans = parts.select("image_name", spelt.alias("text"), F.lit("Geo_Town").alias("label"))
    known = parts.groupBy("name").agg(F.min("image_name").cast("bigint").alias("geoname_id")).withColumn("rank", F.lit(0))
    return linking.link_alike(spans, known).select("image_name", "text", F.array_join("geoname_ids", ";").alias("ids"))


@query(f"""WITH s AS ({_NAMED}), v AS (SELECT image_name // 5 AS image_name, label, text, c_nationkey FROM s), g AS (SELECT image_name, text, CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE c_nationkey END AS id FROM v WHERE label <> 'Sex'),
p AS (SELECT image_name, text, n_nationkey AS nid FROM v JOIN nation ON text = n_name WHERE label <> 'Sex'),
m AS (SELECT g.image_name, count_if(id = nid OR id = nid + 1000)::BIGINT AS tp, count_if(NOT (id = nid OR id = nid + 1000))::BIGINT AS fp FROM g JOIN p ON g.image_name = p.image_name AND g.text = p.text WHERE id IS NOT NULL GROUP BY ALL),
i AS (SELECT image_name FROM g UNION SELECT image_name FROM p), c AS (SELECT image_name, count(id) AS n FROM g GROUP BY ALL),
a AS (SELECT i.image_name, coalesce(n, 0) > 0 AS valid, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, 0::BIGINT AS fn FROM i LEFT JOIN c USING (image_name) LEFT JOIN m USING (image_name)), q AS (SELECT *, {_SCORES} FROM a)
SELECT image_name, valid, tp, fp, fn, CASE WHEN valid THEN precision END AS precision, CASE WHEN valid THEN recall END AS recall, CASE WHEN valid THEN f1 END AS f1 FROM (SELECT *, {_F1} FROM q)""")
def link_prf(spark, sf_dir):
    places = _places(spark, sf_dir).where("label <> 'Sex'").withColumn("image_name", F.floor(F.col("image_name") / 5))
    truth = places.select("image_name", "text", F.when(F.col("c_nationkey") % 6 != 0, F.col("c_nationkey")).cast("bigint").alias("geoname_id"))
    return evaluation.link_scores(truth, linking.link_spans(places, _gazetteer(spark, sf_dir)))


# ---------------------------------------------------------------- outputs

def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with the tags of those not flagged N and the links of those flagged R."""
    r = regions(spark, sf_dir).withColumnRenamed("l_returnflag", "text").drop("l_linestatus").withColumns({"width": F.lit(1920), "height": F.lit(1080)})
    spans = _spans(spark, sf_dir).where("label <> 'N'")
    links = spans.where("label = 'R'").select("image_name", "region_idx", F.lit(0).alias("link_idx"), F.lit("place").alias("text"), F.lit("Geo_Town").alias("label"), F.array((F.col("image_name") % 100).cast("bigint"), F.lit(7).cast("bigint")).alias("geoname_ids"))
    return region_rows(r, spans, links)


@query(f"""WITH {REGIONS_SQL} SELECT image_name, region_idx, 'readingOrder {{index:' || region_idx || ';}}' || CASE WHEN l_returnflag = 'N' THEN '' ELSE ' ' || l_returnflag || ' {{offset:' || x || '; length:' || w || ';}}' END AS custom,
CASE WHEN l_returnflag = 'R' THEN 'place,' || (image_name % 100) || ',7' ELSE '' END AS links FROM regions""")
def page_region_assembly(spark, sf_dir):
    links = F.array_join(F.transform("links", lambda x: F.concat_ws(",", x["text"], F.array_join(x["geoname_ids"], ","))), ";")
    return _assembled(spark, sf_dir).select("image_name", "region_idx", custom_string(F.col("region_idx"), F.col("spans")).alias("custom"), links.alias("links"))


@query(f"""WITH {REGIONS_SQL} SELECT image_name, '{{"image_index":' || image_name || ',"regions":[' || string_agg('{{"bbox":[' || x || ',' || y || ',' || w || ',' || h || '],"text":"' || l_returnflag || '"}}', ',' ORDER BY region_idx) || ']}}' AS json FROM regions GROUP BY image_name""")
def ocr_json_out(spark, sf_dir):
    r = regions(spark, sf_dir).withColumn("text", F.col("l_returnflag")).withColumn("image_index", F.col("image_name"))
    return recognition_json(r)


_POINTS = "concat(x, ',', y, ' ', x + w, ',', y, ' ', x + w, ',', y + h, ' ', x, ',', y + h)"


@query(f"""WITH {REGIONS_SQL}, e AS (SELECT *, {_POINTS} AS p, repeat(' ', 12) AS i FROM regions),
r AS (SELECT image_name, region_idx, '            <RegionRefIndexed index="' || region_idx || '" regionRef="TextRegion_' || region_idx || '"/>' AS o,
 '        <TextRegion id="TextRegion_' || region_idx || '" custom="readingOrder {{index:' || region_idx || ';}}">' || chr(10) || i || '<Coords points="' || p || '"/>' || chr(10)
 || i || '<TextLine custom="readingOrder {{index:' || region_idx || ';}}' || CASE WHEN l_returnflag = 'N' THEN '' ELSE ' ' || l_returnflag || ' {{offset:' || x || '; length:' || w || ';}}' END || '" id="line_1">' || chr(10)
 || i || '    <Coords points="' || p || '"/>' || chr(10) || i || '    <Baseline points="' || p || '"/>' || chr(10) || i || '    <TextEquiv>' || chr(10) || i || '        <Unicode>' || l_returnflag || '</Unicode>' || chr(10) || i || '    </TextEquiv>' || chr(10) || i || '</TextLine>' || chr(10)
 || i || '<TextEquiv>' || chr(10) || i || '    <Unicode>' || l_returnflag || '</Unicode>' || chr(10) || i || '</TextEquiv>' || chr(10)
 || CASE WHEN l_returnflag = 'R' THEN i || '<EntityLinking id="entity_linking_0" text="place" label="Geo_Town" geoname_ids="[' || (image_name % 100) || ', 7]"/>' || chr(10) ELSE '' END || '        </TextRegion>' AS t FROM e)
SELECT image_name, '<PcGts xmlns="{NAMESPACE}">' || chr(10) || '    <Metadata>' || chr(10) || '        <Creator>quireflow</Creator>' || chr(10) || '        <Created>2024-05-06T07:08:09.000000</Created>' || chr(10) || '        <LastChange>2024-05-06T07:08:09.000000</LastChange>' || chr(10) || '    </Metadata>' || chr(10)
 || '    <Page imageFilename="' || image_name || '" imageWidth="1920" imageHeight="1080">' || chr(10) || '        <ReadingOrder>' || chr(10) || '            <OrderedGroup id="ro_group_1">' || chr(10) || string_agg('    ' || o, chr(10) ORDER BY region_idx) || chr(10) || '            </OrderedGroup>' || chr(10) || '        </ReadingOrder>' || chr(10)
 || string_agg(t, chr(10) ORDER BY region_idx) || chr(10) || '    </Page>' || chr(10) || '</PcGts>' AS xml FROM r GROUP BY image_name""")
def page_xml_out(spark, sf_dir):
    return page_xml(_assembled(spark, sf_dir), at=F.lit("2024-05-06 07:08:09").cast("timestamp"))


# ---------------------------------------------------------------- experiment metrics

_KINDS = ["click", "view", "error", "purchase", "signup"]


@query("SELECT user_id, round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS click, round(avg(CASE WHEN event_type = 'view' THEN value END), 6) AS view FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id")
def metric_pivot(spark, sf_dir):
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    return metrics.pivoted(e, "user_id", "event_type", "value", ["click", "view"]).select("user_id", F.round("click", 6).alias("click"), F.round("view", 6).alias("view"))


@query("SELECT user_id AS step, event_type AS name, value FROM events WHERE event_type NOT IN ('click', 'view')")
def metric_split(spark, sf_dir):
    return table(spark, sf_dir, "events").where(~F.col("event_type").isin("click", "view")).select(F.col("user_id").alias("step"), F.col("event_type").alias("name"), "value")


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS bbox_index FROM events")
def metric_event_index(spark, sf_dir):
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    return table(spark, sf_dir, "events").select("event_id", "user_id", (F.row_number().over(w) - 1).alias("bbox_index"))


@query("SELECT count(*) AS n, count(v) AS n_valid, count(v) / count(*)::DOUBLE AS coverage FROM (SELECT CASE WHEN event_type <> 'error' THEN value END AS v FROM events)")
def metric_coverage(spark, sf_dir):
    return metrics.coverage(table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "error", F.col("value")).alias("v")), "v")


@query("SELECT event_id, value FROM events WHERE event_type <> 'error'")
def metric_dropna(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")).na.drop(subset=["value"])


@query("WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT least(floor((value - lo) / (hi - lo) * 50), 49)::INT AS bin, count(*) AS n FROM events, b GROUP BY 1")
def metric_histogram(spark, sf_dir):
    return metrics.histogram(table(spark, sf_dir, "events"), "value", 50)


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def metric_last_row(spark, sf_dir):
    return metrics.last_rows(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", ["event_id"])


@query("SELECT b AS batch, sum(n) OVER (ORDER BY b)::BIGINT AS n, round(sum(s) OVER (ORDER BY b), 4) AS total FROM (SELECT event_id // 500 AS b, count(*) AS n, sum(value) AS s FROM events GROUP BY ALL)")
def metric_flush_cumulative(spark, sf_dir):
    return metrics.cumulative_flushes(table(spark, sf_dir, "events"), "event_id", 500, "value").withColumn("total", F.round("total", 4))


@query("SELECT coalesce(a.event_id, b.event_id) AS event_id, a.value AS value_a, b.value AS value_b, round(b.value - a.value, 6) AS difference FROM events a FULL JOIN (SELECT event_id + 7 AS event_id, value * 2 AS value FROM events) b ON a.event_id = b.event_id")
def run_comparison(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    other = e.select((F.col("event_id") + 7).alias("event_id"), (F.col("value") * 2).alias("value"))
    return metrics.compared_runs(e, other, ["event_id"], "value").withColumn("difference", F.round("difference", 6))


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, event_type, value FROM events WHERE value > 50")
def event_union(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return e.where("event_type = 'click'").unionByName(e.where("value > 50"))


@query("SELECT event_id, (json_extract(props, '$.k'))::INT AS k FROM events")
def event_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


#: Images of a run between flushes, and files that the stream reads one by one; neither divides the other.
_EVERY, _FILES = 7, 6


@query(f"""WITH r AS (SELECT user_id::VARCHAR AS run, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, value FROM events),
c AS (SELECT run, i, sum(value) OVER (PARTITION BY run ORDER BY i) AS total, count(*) OVER (PARTITION BY run) AS n FROM r)
SELECT run, ((i - 1) // {_EVERY})::BIGINT AS flush, i AS images, round(total, 4) AS total, i % {_EVERY} = 0 AS done FROM c WHERE i % {_EVERY} = 0 OR i = n""")
def stream_flush(spark, sf_dir):
    """All events as images of their user's run, streamed file by file; a run's last flush is the one that is open when it ends."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("run"), "value")
    bounds = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    if bounds.lo is None:
        return spark.createDataFrame([], FLUSH)
    part = F.floor((F.col("event_id") - bounds.lo) * _FILES / (bounds.hi - bounds.lo + 1))
    for i in range(_FILES):  # one after the other, so that the stream's source finds them in this order
        events.where(part == i).select("run", F.col("event_id").alias("place"), "value").coalesce(1).write.mode("append").parquet(f"{base}/in")
    images = spark.readStream.schema("run string, place bigint, value double").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    sink = MetricSink(spark, f"{base}/out", "run")
    flush_counted(spark, images, _EVERY, sink, f"{base}/state").awaitTermination()
    return flush_table(sink).withColumn("total", F.round("total", 4))
