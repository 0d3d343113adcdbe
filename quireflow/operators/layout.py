"""Mask filtering and layout scores as window and aggregate queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.functions.geometry import box_iou


def filter_masks(masks: DataFrame, image: str = "image_name", least_area_share: float = 0.01, least_fill: float = 0.9) -> DataFrame:
    """Masks (image, mask_idx, w, h, area, has_holes, image_px) kept, with region_idx by falling area.

    An image's only mask always stays. Otherwise a mask must cover more than the least share of the image, fill its
    box and have no holes; if none does, the largest stays. Masks with an empty box never pass.
    """
    own = Window.partitionBy(image)
    by_area = own.orderBy(F.col("area").desc(), "mask_idx")
    fill = F.try_divide(F.col("area").cast("double"), F.col("w") * F.col("h"))
    passes = (F.try_divide(F.col("area").cast("double"), F.col("image_px")) > least_area_share) & (fill > least_fill) & ~F.col("has_holes")
    judged = masks.withColumns({"_n": F.count(F.lit(1)).over(own), "_ok": F.coalesce(passes, F.lit(False)), "_rank": F.row_number().over(by_area)})
    judged = judged.withColumn("_any", F.max("_ok").over(own))
    kept = judged.where((F.col("_n") == 1) | F.col("_ok") | (~F.col("_any") & (F.col("_rank") == 1)))
    return kept.withColumn("region_idx", F.row_number().over(by_area) - 1).drop("_n", "_ok", "_rank", "_any")


def region_pairs(truth: DataFrame, predicted: DataFrame, image: str = "image_name") -> DataFrame:
    """(image, gt_idx, pred_idx, iou) of boxes that overlap; pairs apart are absent and count as zero."""
    a = truth.select(image, F.col("region_idx").alias("gt_idx"), F.col("box").alias("a"))
    b = predicted.select(image, F.col("region_idx").alias("pred_idx"), F.col("box").alias("b"))
    apart = (F.col("a.x") >= F.col("b.x") + F.col("b.w")) | (F.col("b.x") >= F.col("a.x") + F.col("a.w")) | (F.col("a.y") >= F.col("b.y") + F.col("b.h")) | (F.col("b.y") >= F.col("a.y") + F.col("a.h"))
    return a.join(b, image).where(~apart).select(image, "gt_idx", "pred_idx", box_iou(F.col("a"), F.col("b")).alias("iou")).where("iou > 0")


def region_counts(truth: DataFrame, predicted: DataFrame, image: str = "image_name") -> DataFrame:
    """(image, n_gt, n_pred), with images that only one side has."""
    sides = truth.select(image, F.lit(1).alias("g"), F.lit(0).alias("p")).unionAll(predicted.select(image, F.lit(0), F.lit(1)))
    return sides.groupBy(image).agg(F.sum("g").alias("n_gt"), F.sum("p").alias("n_pred"))


def average_iou(pairs: DataFrame, counts: DataFrame, image: str = "image_name") -> DataFrame:
    """(image, n_gt, n_pred, avg_iou): each true region's best overlap, averaged with a zero per missing or spare region.

    One prediction may serve several true regions. Null where nothing is to be averaged.
    """
    best = pairs.where((F.col("iou") > 0) & ~F.isnan("iou")).groupBy(image, "gt_idx").agg(F.max("iou").alias("m"))
    per_image = best.groupBy(image).agg(F.sum("m").alias("s"), F.count("m").alias("c"))
    both = counts.join(per_image, image, "left")
    divisor = F.coalesce("c", F.lit(0)) + F.abs(F.col("n_gt") - F.col("n_pred"))
    return both.select(image, "n_gt", "n_pred", F.try_divide(F.coalesce("s", F.lit(0.0)), divisor.cast("double")).alias("avg_iou"))


def region_scores(regions: DataFrame, is_truth: Column, is_predicted: Column, image: str = "image_name") -> DataFrame:
    """average_iou of one table that holds both sides (a region may be on both): it is read and numbered once.

    Each image's boxes meet in one row; its pairs are made and averaged there.
    """
    side = lambda on: F.filter(F.collect_list(F.when(on, F.struct(F.col("box.x").alias("x"), F.col("box.y").alias("y"), F.col("box.w").alias("w"), F.col("box.h").alias("h")))), lambda b: b.isNotNull())
    both = regions.groupBy(image).agg(side(is_truth).alias("g"), side(is_predicted).alias("p")).where((F.size("g") > 0) | (F.size("p") > 0))
    best = F.transform("g", lambda g: F.coalesce(F.array_max(F.filter(F.transform("p", lambda p: box_iou(g, p)), lambda v: v > 0)), F.lit(0.0)))
    met = both.select(image, F.size("g").cast("long").alias("n_gt"), F.size("p").cast("long").alias("n_pred"), F.filter(best, lambda v: v > 0).alias("m"))
    total = F.aggregate("m", F.lit(0.0), lambda s, v: s + v)
    return met.select(image, "n_gt", "n_pred", F.try_divide(total, (F.size("m") + F.abs(F.col("n_gt") - F.col("n_pred"))).cast("double")).alias("avg_iou"))
